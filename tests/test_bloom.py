"""The Bloom filter before an insert-ignore: nothing lost, little let through."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from homestead.operators import bloom, keyed as K


def urls(spark, n, step=1, start=0):
    return spark.range(start, start + n * step, step).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("url"))


def test_lets_every_batch_key_through_and_few_others(spark):
    target, batch = urls(spark, 200_000), urls(spark, 1_000, 97, 100_000)
    passed = bloom.may_hold(target, batch, ["url"], blocks=64)
    n, wanted = passed.count(), target.join(batch, "url", "left_semi")
    assert wanted.join(passed, "url", "left_anti").count() == 0
    assert wanted.count() <= n <= wanted.count() + 4_000           # 4 bits a key, 4 keys a word


def test_full_filter_is_still_exact(spark):
    target, batch = urls(spark, 5_000), urls(spark, 20_000, 1, 2_500)
    got = bloom.may_hold(target, batch, ["url"], blocks=1)
    assert target.join(batch, "url", "left_semi").join(got, "url", "left_anti").count() == 0
    assert K.new_rows(target, batch, ["url"], prefilter=True).count() == 17_500


@pytest.mark.parametrize("rows", [[], [("a", 1), ("a", 2), (None, 3), ("", 4), ("z", 5), ("z", 5)]])
def test_insert_ignore_same_with_and_without(spark, rows):
    schema = "url string, v int"
    for held in ([], [("a", 0), ("b", 0), (None, 0)]):
        target, new = spark.createDataFrame(held, schema), spark.createDataFrame(rows, schema)
        plain = sorted(K.insert_ignore(target, new, "url").collect(), key=repr)
        assert sorted(K.insert_ignore(target, new, "url", prefilter=True).collect(), key=repr) == plain


def test_compound_keys_and_unlike_types(spark):
    target = spark.createDataFrame([(1, dt.date(2026, 1, 1)), (2, dt.date(2026, 1, 1))], "k long, d date")
    new = spark.createDataFrame([(1, dt.date(2026, 1, 1)), (1, dt.date(2026, 1, 2))], "k long, d date")
    assert [tuple(r) for r in K.new_rows(target, new, ["k", "d"], prefilter=True).collect()] == [(1, dt.date(2026, 1, 2))]
    short = new.select(F.col("k").cast("int").alias("k"), "d")      # hashes differ: no filter, same answer
    assert not bloom.can_filter(target, short, ["k", "d"])
    assert K.new_rows(target, short, ["k", "d"], prefilter=True).count() == 1
    real = [f.select(F.col("k").cast("double").alias("k")) for f in (target, new)]
    assert not bloom.can_filter(*real, ["k"])


def test_size_bound_follows_the_session(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    target, batch = urls(spark, 100), urls(spark, 10, 1, 95)
    try:
        sizes = {}
        for limit in ("-1", "100", "1048576", "10485760"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            sizes[limit] = bloom.block_count(spark)
            assert K.new_rows(target, batch, ["url"], prefilter=True).count() == 5
            assert sizes[limit] * bloom.BLOCK_BYTES <= max(0, int(limit))
        assert sizes["-1"] == sizes["100"] == 0 < sizes["1048576"] < sizes["10485760"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_target_is_filtered_before_it_is_shuffled(spark, tmp_path):
    urls(spark, 50_000).write.parquet(f"{tmp_path}/t")
    urls(spark, 100, 1, 49_990).write.parquet(f"{tmp_path}/n")
    target, new = spark.read.parquet(f"{tmp_path}/t"), spark.read.parquet(f"{tmp_path}/n")
    plan = K.new_rows(target, new, ["url"], prefilter=True)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    scan = next(i for i, x in enumerate(lines) if "FileScan" in x and f"{tmp_path}/t" in x)
    above = [x for x in lines[:scan] if "BroadcastHashJoin" in x or "hashpartitioning(url" in x]
    assert "BroadcastHashJoin" in above[-1] or "Inner" in above[-1], plan
