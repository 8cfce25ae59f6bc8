"""One key holding far more than a third of all rows: results stay whole and
exact (nothing dropped, capped or sampled)."""

import random

from pyspark.sql import functions as F

from homestead.operators import keyed as K
from homestead.operators import marts as M


def _rows(n_hot=20000, n_cold=10000, seed=5):
    rnd = random.Random(seed)
    rows = [("hot", i, rnd.random()) for i in range(n_hot)]
    rows += [(f"k{rnd.randrange(2000)}", n_hot + i, rnd.random()) for i in range(n_cold)]
    return rows


def test_skewed_dedupe_and_means(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "k string, t long, v double").repartition(16)
    latest = {r.k: r.t for r in K.latest_per_key(df, ["k"], [F.col("t").desc()], ["t"]).collect()}
    want = {}
    for k, t, _ in rows:
        want[k] = max(t, want.get(k, -1))
    assert latest == want
    means = {r.k: r.mean_value for r in M.group_mean(df, "k", "v").collect()}
    hot = [v for k, _, v in rows if k == "hot"]
    assert abs(means["hot"] - sum(hot) / len(hot)) < 1e-9
    assert len(means) == len(want)


def test_skewed_upsert_and_insert(spark):
    rows = _rows()
    links = spark.createDataFrame([(k,) for k, _, _ in rows], "url string").repartition(16)
    target = spark.createDataFrame([("k1", "crawled"), ("zz", "pending")], "url string, status string")
    out = K.insert_ignore(target, links, ["url"], defaults={"status": F.lit("pending")})
    assert K.key_violations(out, ["url"]).count() == 0
    assert out.count() == len({k for k, _, _ in rows} | {"zz"})
    src = spark.createDataFrame([(k, "new") for k in {k for k, _, _ in rows}], "url string, status string")
    up = K.upsert(out, src, ["url"])
    assert up.filter("status = 'new'").count() == src.count()
    assert up.count() == out.count()


def test_skewed_histogram_counts_every_row(spark):
    rows = _rows()
    df = spark.createDataFrame([(0.5 if k == "hot" else v,) for k, _, v in rows], "v double").repartition(16)
    h = M.histogram(df, "v", 20).collect()
    assert sum(r.n_rows for r in h) == len(rows)
