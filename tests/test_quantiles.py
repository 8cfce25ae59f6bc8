"""Exact distributed quantiles against numpy, including a hot group that
holds most rows and values repeated many times."""

import numpy as np
import pytest

from homestead.operators import marts as M
from homestead.operators import quantiles as Q


def _data(seed=3):
    rnd = np.random.default_rng(seed)
    rows = []
    for i in range(6000):                       # hot group: ~2/3 of the rows
        rows.append(("hot", float(rnd.integers(0, 500))))
    for g, n in (("a", 1), ("b", 2), ("c", 7), ("d", 400)):
        rows += [(g, float(x)) for x in rnd.normal(50, 20, n).round(2)]
    rows += [("d", None), (None, 3.0)]
    return rows


def _type5(x, p):
    n = len(x)
    h = min(max(n * p + 0.5, 1.0), n)
    lo = int(np.floor(h)); hi = min(int(np.ceil(h)), n)
    return x[lo - 1] + (h - lo) * (x[hi - 1] - x[lo - 1])


@pytest.mark.parametrize("method", ["linear", "midpoint"])
def test_exact_quantiles_match_numpy(spark, method):
    data = _data()
    df = spark.createDataFrame(data, "g string, v double").repartition(7)
    got = {r.g: r for r in Q.exact_quantiles(df, "g", "v", [0.25, 0.5, 0.75, 0.9],
                                             ["q1", "q2", "q3", "q9"], method=method).collect()}
    groups = {}
    for g, v in data:
        if g is not None and v is not None:
            groups.setdefault(g, []).append(v)
    assert set(got) == set(groups)
    for g, vals in groups.items():
        x = np.sort(np.array(vals))
        for name, p in (("q1", .25), ("q2", .5), ("q3", .75), ("q9", .9)):
            want = np.quantile(x, p) if method == "linear" else _type5(x, p)
            assert got[g][name] == pytest.approx(want, abs=1e-9), (g, name)
        assert got[g].n == len(vals)


def test_box_stats_fixture(spark):
    df = spark.createDataFrame([("a", float(v)) for v in (1, 2, 3, 4)], "g string, v double")
    r = Q.box_stats(df, "g", "v").first()
    assert (r.q1, r.median, r.q3) == (1.75, 2.5, 3.25)
    assert (r.lower_whisker, r.upper_whisker, r.n_outliers) == (1.0, 4.0, 0)


def test_box_stats_outliers(spark):
    vals = [1, 2, 3, 4, 5, 6, 7, 8, 100]
    df = spark.createDataFrame([("a", float(v)) for v in vals], "g string, v double")
    r = Q.box_stats(df, "g", "v").first()
    assert r.upper_whisker == 8.0 and r.n_outliers == 1


def test_histogram_properties(spark):
    rnd = np.random.default_rng(1)
    vals = [float(x) for x in rnd.exponential(10, 2000)] + [None]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    h = M.histogram(df, "v", 20).collect()
    assert sum(r.n_rows for r in h) == 2000
    assert all(0 <= r.bin < 20 for r in h)
    top = max(v for v in vals if v is not None)
    last = [r for r in h if r.bin == 19]
    assert last and last[0].bin_hi == pytest.approx(top)


def test_histogram_single_value(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "v double")
    h = M.histogram(df, "v", 20).collect()
    assert [(r.bin, r.n_rows) for r in h] == [(0, 2)]


def test_share_sums_to_total(spark):
    df = spark.createDataFrame([(1,), (0,), (1,), (None,)], "f int")
    got = {r.label: r.n_rows for r in M.share_two_way(df, "f").collect()}
    assert got == {"flagged": 2, "rest": 2}


def test_nan_counts_as_missing(spark):
    nan = float("nan")
    df = spark.createDataFrame([("a", v) for v in (1.0, 2.0, 3.0, 4.0, nan, None)], "g string, v double")
    r = Q.box_stats(df, "g", "v").first()
    assert (r.n, r.q1, r.q3, r.n_outliers, r.upper_whisker) == (4, 1.75, 3.25, 0, 4.0)
    assert M.bounds(df, ["v"]).first() == (1.0, 4.0)
    assert sum(x.n_rows for x in M.histogram(df, "v", 20).collect()) == 4


def test_box_stats_of_a_hot_group_over_many_blocks(spark):
    rnd = np.random.default_rng(11)
    hot = np.concatenate([rnd.normal(0, 10, 30000), rnd.normal(0, 400, 300)])
    rows = [("hot", float(x)) for x in hot] + [("cold", float(x)) for x in rnd.normal(5, 1, 200)]
    got = {r.g: r for r in Q.box_stats(spark.createDataFrame(rows, "g string, v double").repartition(9), "g", "v").collect()}
    for g in ("hot", "cold"):
        x = np.array([v for k, v in rows if k == g])
        q1, q3 = np.quantile(x, [.25, .75])
        inside = x[(x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))]
        assert (got[g].lower_whisker, got[g].upper_whisker, got[g].n_outliers) == (inside.min(), inside.max(), len(x) - len(inside))


def test_value_table_is_never_shuffled_on_the_group(spark):
    import re
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    for k in old:
        spark.conf.set(k, "-1")
    try:
        out = Q.box_stats(spark.read.parquet("/root/testdata/sf0.001/events.parquet"), "event_type", "value")
        out.write.format("noop").mode("overwrite").save()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    final = plan.split("== Initial Plan ==")[0]
    assert len(re.findall(r"\bExchange ", final)) <= 8
    for line in final.splitlines():
        if "Exchange hashpartitioning(event_type" in line:
            assert "blk" in line or "value" not in line


def _want(rows, groups, whisker=1.5):
    out = {}
    for g in groups:
        x = np.array([v for k, v in rows if k == g])
        q1, q2, q3 = np.quantile(x, [.25, .5, .75])
        inside = x[(x >= q1 - whisker * (q3 - q1)) & (x <= q3 + whisker * (q3 - q1))]
        out[g] = (len(x), q1, q2, q3, inside.min(), inside.max(), len(x) - len(inside))
    return out


def _got(df):
    return {r.g: (r.n, r.q1, r.median, r.q3, r.lower_whisker, r.upper_whisker, r.n_outliers)
            for r in Q.box_stats(df, "g", "v").collect()}


def _hot_rows(n):
    rnd = np.random.default_rng(5)
    rows = [("hot", float(x)) for x in rnd.normal(0, 10, n)]
    return rows + [("ties", float(x)) for x in rnd.integers(0, 3, 9000)] + [("few", 4.0), ("few", 9.0)]


def test_only_values_near_the_wanted_ranks_are_ranked(spark, monkeypatch):
    """The range shuffle gets a few percent of a large group, spread over several blocks."""
    rows, seen, blocks_of = _hot_rows(60000), [], Q.value_blocks

    def spied(counted):
        blocks = blocks_of(counted)
        hot = blocks.filter("g = 'hot'")
        seen.append((hot.count(), hot.select("blk").distinct().count()))
        return blocks
    monkeypatch.setattr(Q, "value_blocks", spied)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")         # so few rows make one block otherwise
    try:
        got = _got(spark.createDataFrame(rows, "g string, v double").repartition(7))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for g, want in _want(rows, ("hot", "ties", "few")).items():
        assert got[g] == pytest.approx(want), g
    assert len(seen) == 1 and 0 < seen[0][0] < 0.05 * 60000 and seen[0][1] > 1


@pytest.mark.parametrize("wrong", ["below", "above", "narrow"])
def test_groups_whose_brackets_miss_are_done_again(spark, monkeypatch, wrong):
    rows, honest, again = _hot_rows(9000), Q.brackets, []

    def misled(values, probs):
        found, fits = honest(values, probs)
        for j in range(len(probs)):
            lo, hi = {"below": ("lo{0} - 100", "lo{0} - 90"), "above": ("hi{0} + 90", "hi{0} + 100"),
                      "narrow": ("hi{0}", "hi{0}")}[wrong]
            lo, hi = lo.format(j), hi.format(j)
            found = found.selectExpr("*", f"if(g = 'hot', {lo}, lo{j}) as a", f"if(g = 'hot', {hi}, hi{j}) as b") \
                .drop(f"lo{j}", f"hi{j}").withColumnsRenamed({"a": f"lo{j}", "b": f"hi{j}"})
        return found, fits
    whole = Q._all_blocks
    monkeypatch.setattr(Q, "brackets", misled)
    monkeypatch.setattr(Q, "_all_blocks", lambda values: again.append([r.g for r in values.select("g").distinct().collect()])
                        or whole(values))
    got = _got(spark.createDataFrame(rows, "g string, v double").repartition(3))
    for g, want in _want(rows, ("hot", "ties", "few")).items():
        assert got[g] == pytest.approx(want), g
    assert again == [["hot"]]


def test_column_types_names_order_and_empty_tables(spark):
    """Decimals and longs, columns named like the operator's own, probabilities out of order."""
    rows = [(k % 3, k, k * 2) for k in range(300)]
    df = spark.createDataFrame(rows, "n int, c long, v long").selectExpr("n", "c", "cast(v as decimal(12, 2)) as v")
    got = {r[0]: r for r in Q.exact_quantiles(df, "n", "c", [0.9, 0.1], ["hi", "lo"]).withColumnRenamed("hi", "h")
           .toDF("n", "rows", "hi", "lo").collect()}
    for k in range(3):
        x = np.arange(k, 300, 3)
        assert (got[k].rows, got[k].hi, got[k].lo) == (100, pytest.approx(np.quantile(x, .9)), pytest.approx(np.quantile(x, .1)))
    box = {r[0]: r for r in Q.box_stats(df.withColumnRenamed("n", "g"), "g", "v").collect()}
    assert [float(box[1][c]) for c in ("q1", "median", "q3")] == pytest.approx(
        list(np.quantile(np.arange(2, 600, 6), [.25, .5, .75])))
    assert Q.box_stats(df.withColumnRenamed("n", "g").limit(0), "g", "v").collect() == []
