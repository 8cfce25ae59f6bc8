"""Properties of the keyed operators (dedupe, upsert, insert-ignore, status)."""

import random

from pyspark.sql import functions as F

from homestead.operators import keyed as K


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_upsert_example(spark):
    t = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    s = spark.createDataFrame([("b", 9), ("c", 3)], "k string, v int")
    assert rows(K.upsert(t, s, "k")) == [("a", 1), ("b", 9), ("c", 3)]


def test_upsert_idempotent_and_count(spark):
    rnd = random.Random(7)
    t = spark.createDataFrame([(i, rnd.random()) for i in range(0, 300)], "k long, v double")
    s = spark.createDataFrame([(i, rnd.random()) for i in range(200, 500)], "k long, v double")
    once = K.upsert(t, s, ["k"])
    twice = K.upsert(once, s, ["k"])
    assert rows(once) == rows(twice)
    matched = t.join(s, "k", "left_semi").count()
    assert once.count() == t.count() + s.count() - matched
    assert K.key_violations(once, ["k"]).count() == 0


def test_latest_per_key_order_insensitive(spark):
    data = [("a", 1, "x"), ("a", 3, "y"), ("a", 3, "z"), ("b", 2, "q"), (None, 1, "n1"), (None, 2, "n2")]
    out = []
    for seed in (1, 2, 3):
        shuffled = data[:]
        random.Random(seed).shuffle(shuffled)
        df = spark.createDataFrame(shuffled, "k string, t int, p string").repartition(3)
        out.append(rows(K.latest_per_key(df, ["k"], [F.col("t").desc()], ["t"])))
    assert out[0] == out[1] == out[2]
    # NULL keys collapse to one group; ties broken by the other columns
    assert set(out[0]) == {("a", 3, "y"), ("b", 2, "q"), (None, 2, "n2")}


def test_dedupe_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, v int")
    assert K.any_per_key(df, "k").count() == 2


def test_insert_ignore(spark):
    t = spark.createDataFrame([("u1", "crawled"), ("u2", "pending")], "url string, status string")
    new = spark.createDataFrame([("u2",), ("u3",), ("u3",), ("u4",)], "url string")
    out = K.insert_ignore(t, new, ["url"], defaults={"status": F.lit("pending")})
    assert rows(out) == [("u1", "crawled"), ("u2", "pending"), ("u3", "pending"), ("u4", "pending")]
    assert K.new_rows(t, new, ["url"]).count() == 2
    again = K.insert_ignore(out, new, ["url"], defaults={"status": F.lit("pending")})
    assert rows(again) == rows(out)


def test_observed_count(spark):
    t = spark.createDataFrame([("u1",)], "url string")
    new = spark.createDataFrame([("u1",), ("u2",), ("u3",)], "url string")
    added, obs = K.observed_count(K.new_rows(t, new, ["url"]), "n_new")
    added.write.format("noop").mode("overwrite").save()
    assert obs.get["n_new"] == 2


def test_update_status(spark):
    f = spark.createDataFrame([("u1", "pending"), ("u2", "pending"), ("u3", "crawled")], "url string, status string")
    done = spark.createDataFrame([("u1",), ("u1",), ("zz",)], "url string")
    assert rows(K.update_status(f, done)) == [("u1", "crawled"), ("u2", "pending"), ("u3", "crawled")]


def test_key_violations(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    got = {r.k: r.n_rows for r in K.key_violations(df, "k").collect()}
    assert got == {"a": 2, None: 1}


def test_upsert_reduces_duplicate_source_keys(spark):
    t = spark.createDataFrame([("a", 1, 0)], "k string, v int, ts int")
    s = spark.createDataFrame([("a", 5, 1), ("a", 7, 2), ("b", 3, 1)], "k string, v int, ts int")
    out = K.upsert(t, s, "k", source_order=[F.col("ts").desc()])
    assert rows(out) == [("a", 7, 2), ("b", 3, 1)]


def test_broadcast_fits_checks_threshold(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
        assert K.broadcast_fits(spark, 1000) and not K.broadcast_fits(spark, 10_485_761)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert not K.broadcast_fits(spark, 1)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_upsert_broadcast_keys_leaves_target_unshuffled(spark):
    t = spark.range(1000).selectExpr("id as k", "id * 2 as v")
    s = spark.range(990, 1010).selectExpr("id as k", "id * 3 as v")
    out = K.upsert(t, s, ["k"], broadcast_source_keys=True)
    out.write.format("noop").mode("overwrite").save()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan and "SortMergeJoin" not in plan
    assert out.count() == 1010 and out.filter("k >= 990 and v = k * 3").count() == 20


def test_null_keys_are_never_written(spark):
    t = spark.createDataFrame([("a", "crawled")], "url string, status string")
    new = spark.createDataFrame([(None,), ("b",), (None,)], "url string")
    out = K.insert_ignore(t, new, ["url"], defaults={"status": F.lit("pending")})
    assert rows(out) == [("a", "crawled"), ("b", "pending")]
    src = spark.createDataFrame([(None, "x"), ("a", "new")], "url string, status string")
    assert rows(K.upsert(t, src, ["url"])) == [("a", "new")]


def test_insert_ignore_keeps_payload_and_one_survivor(spark):
    t = spark.createDataFrame([("a", "x", "old")], "k string, p string, s string")
    new = spark.createDataFrame([("a", "y"), ("b", "q"), ("b", "p"), (None, "z")], "k string, p string")
    out = K.insert_ignore(t, new, ["k"], defaults={"s": F.lit("new"), "p": F.lit("default")})
    assert rows(out) == [("a", "x", "old"), ("b", "p", "new")]


def test_upsert_reduces_a_repeated_key_without_an_order(spark):
    t = spark.createDataFrame([("a", 1)], "k string, v int")
    s = spark.createDataFrame([("b", 5), ("b", 4), (None, 3), ("a", 2), ("a", 2)], "k string, v int")
    assert rows(K.upsert(t, s, "k")) == [("a", 2), ("b", 4)]
