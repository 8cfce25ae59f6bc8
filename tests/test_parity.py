"""Every registered query against its DuckDB oracle at sf0.01 (the driver's
correctness gate), plus the smoke entry point at sf0.001."""

import pytest

from homestead.plans.catalog import QUERIES
from homestead.plans.oracle import ORACLE
from parity import SF01, compare

WITH_ORACLE = [n for n in QUERIES if n in ORACLE]
WITHOUT_ORACLE = [n for n in QUERIES if n not in ORACLE]


def test_every_query_has_an_oracle():
    assert WITHOUT_ORACLE == []


@pytest.mark.parametrize("name", WITH_ORACLE)
def test_query_matches_oracle(spark, con01, name):
    res = compare(QUERIES[name](spark, SF01), con01, ORACLE[name])
    assert res["cols_match"], res
    assert res["rows_match"], res
    assert res["values_match"], res


def test_extract_document_rows(spark):
    df = QUERIES["extract_document"](spark, SF01)
    assert df.count() == spark.read.parquet(f"{SF01}/pages.parquet").count()


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 15
    assert df.columns == ["district", "mean_price"]
    assert set(QUERIES) <= set(e.oracle_sql()) <= set(e.queries())
