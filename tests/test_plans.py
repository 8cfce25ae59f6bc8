"""Physical-plan properties that matter at scale, checked on the real plans
of the registered queries (with broadcast thresholds off, as for tables far
larger than any threshold)."""

import re

import pytest

from homestead.plans.catalog import QUERIES
from homestead.plans.silver import bronze_to_silver
from homestead.sources.bronze import read_bronze

from parity import SF001

PYTHON_OPS = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas")


def executed_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


SKIP = {"stream_ingest", "stream_dedupe", "partition_roundtrip", "partition_roundtrip_all", "etl_gold", "etl_incremental",
        "etl_incremental_gold"}   # run their own jobs; plans are checked elsewhere


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SKIP])
def test_no_cross_join_no_row_udf(no_broadcast, name):
    plan = executed_plan(QUERIES[name](no_broadcast, SF001))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, plan
    for op in PYTHON_OPS:
        assert op not in plan, (name, op)
    if name == "extract_document":
        assert "MapInArrow" in plan or "PythonMapInArrow" in plan


def _before_exchange(plan: str, marker: str) -> bool:
    """``marker`` appears below (i.e. before) some Exchange in the tree text."""
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            depth = len(line) - len(line.lstrip(" :+-"))
            for below in lines[i + 1:]:
                if marker in below:
                    return True
                if len(below) - len(below.lstrip(" :+-")) <= depth:
                    break
    return False


def test_dedupe_limits_rows_before_shuffle(no_broadcast):
    plan = executed_plan(QUERIES["latest_per_key"](no_broadcast, SF001))
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert _before_exchange(plan, "Partial")


def test_gold_dedupe_limits_rows_before_shuffle(no_broadcast):
    plan = executed_plan(QUERIES["listings_gold"](no_broadcast, SF001))
    assert re.search(r"WindowGroupLimit .*Partial", plan)


@pytest.mark.parametrize("name,marker", [
    ("topk_mean_unit", "partial_avg"),
    ("histogram_20", "partial_count"),
    ("key_violations", "partial_count"),
    ("share_two_way", "partial_sum"),
])
def test_partial_aggregation_before_shuffle(no_broadcast, name, marker):
    plan = executed_plan(QUERIES[name](no_broadcast, SF001))
    assert marker in plan


def test_batch_side_deduplicated_before_join(no_broadcast):
    for name in ("insert_ignore", "update_status"):
        plan = executed_plan(QUERIES[name](no_broadcast, SF001))
        assert re.search(r"HashAggregate\(keys=\[url#\d+\], functions=\[\], output=\[url#\d+\]\)", plan), name


def test_topk_is_take_ordered(no_broadcast):
    plan = executed_plan(QUERIES["report_topk_price"](no_broadcast, SF001))
    assert "TakeOrderedAndProject(limit=15" in plan


def test_column_pruning_reaches_scan(no_broadcast):
    plan = executed_plan(QUERIES["topk_mean_unit"](no_broadcast, SF001))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert "l_partkey:bigint,l_quantity:double,l_extendedprice:double" in schemas
    assert all("l_shipdate" not in s for s in schemas)


def test_silver_is_one_narrow_stage(spark, tmp_path):
    import json
    d = tmp_path / "bronze" / "dt=2026-05-01"
    d.mkdir(parents=True)
    (d / "a.json").write_text(json.dumps({"url": "u", "title": "t", "address_line_2": "Phường A, B",
                                          "crawled_at": "2026-05-01T00:00:00"}), encoding="utf-8")
    plan = executed_plan(bronze_to_silver(read_bronze(spark, str(tmp_path / "bronze"))))
    assert "Exchange" not in plan
    assert "ReadSchema: struct<url:string,title:string,address:string,address_line_2:string" in plan


def test_partitioned_write_rebalances_not_repartitions(spark, tmp_path):
    from homestead.sources.tables import write_partitioned
    df = spark.range(1000).selectExpr("id", "date_add(date'2026-01-01', cast(id % 3 as int)) as dt")
    captured = {}

    class Probe:
        def __init__(self, inner):
            self.inner = inner

        def hint(self, name, *cols):
            captured["hint"] = (name, cols)
            return self.inner.hint(name, *cols)

    write_partitioned(Probe(df), str(tmp_path / "t"))
    assert captured["hint"] == ("rebalance", ("dt",))
    plan = df.hint("rebalance", "dt")._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1000
