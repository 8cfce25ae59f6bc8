"""The JDBC merge statement (no database is started in tests: only the SQL
the driver would send is checked)."""

from homestead import schemas as S
from homestead.sources.jdbc import upsert_sql


def test_upsert_sql_updates_every_non_key_column():
    sql = upsert_sql("fact_listings", "stg_listings")
    assert sql.startswith("INSERT INTO fact_listings (url, project_name,")
    assert "SELECT url, project_name," in sql and "FROM stg_listings" in sql
    assert "ON CONFLICT (url) DO UPDATE SET" in sql
    sets = [line.strip().rstrip(",") for line in sql.splitlines() if "= EXCLUDED." in line]
    assert sets == [f"{c} = EXCLUDED.{c}" for c in S.GOLD_COLUMNS if c != "url"]
    assert len(sets) == 13
