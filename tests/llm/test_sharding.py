import zlib
from collections import Counter

from helpers import empty, odd_documents
from homestead.llm import sharding
from pyspark.sql import functions as F


def jump(key, n):
    key &= (1 << 64) - 1
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) & (1 << 64) - 1
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_hash(spark):
    keys = [0, 1, 2, -1, 10**18, -(1 << 63), (1 << 63) - 1, *range(5, 400)]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for n in (1, 2, 24, 25, 60):
        got = {r.k: r.s for r in df.select("k", sharding.jump_hash(F.col("k"), n).alias("s")).collect()}
        assert got == {k: jump(k, n) for k in keys}


def test_assignment(spark):
    docs = odd_documents(spark, ["more"] * 300)
    rows = sharding.assign_shards(docs, 24).collect()
    text = Counter((r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == text
    for r in rows:
        assert r.law == "key" and r["shard"] == jump(r.doc_id or 0, 24) and r.grown_shard == jump(r.doc_id or 0, 25)
        assert r.grown_shard in (r["shard"], 24)
    for s in range(24):
        slots = sorted(r.slot for r in rows if r["shard"] == s)
        assert slots == list(range(len(slots)))
    assert sharding.assign_shards(empty(spark, docs), 24).collect() == []


def test_plan_is_native(spark):
    docs = odd_documents(spark)
    plan = sharding.assign_shards(docs, 24)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_only_the_needed_fraction_moves(spark):
    df = spark.range(20000).select(sharding.jump_hash(F.col("id"), 24).alias("a"), sharding.jump_hash(F.col("id"), 25).alias("b"))
    moved = df.where("a <> b").count()
    assert df.where("a <> b and b <> 24").count() == 0 and 20000 / 25 * 0.8 < moved < 20000 / 25 * 1.2
