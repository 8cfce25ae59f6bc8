"""Maintained marts equal recomputed ones after every run, from the changed buckets alone."""

from pyspark.sql import functions as F

import pytest

from homestead import schemas as S
from homestead.operators import marts as M
from homestead.plans import mart_views as V
from homestead.plans.etl import read_gold
from homestead.sources.tables import PublishConflict, publish_buckets, publish_version, remove_superseded
from test_io_stream import scratch


def listing(i, city="A", district="d", price=1.0, beds=1, docs=0):
    return {"url": f"u{i}", "city": city, "district": district, "price": price, "area_m2": 10.1 * (i % 7),
            "price_per_m2": None if i % 3 == 0 else 0.1 * i, "num_bedrooms": beds, "has_legal_docs": docs}


def publish(spark, root, rows, n=16, keep=2):
    """Rewrites the buckets that the rows fall into (rows: the buckets' whole new content)."""
    full = [{**{f: None for f in S.GOLD_SCHEMA.fieldNames()}, **r} for r in rows]
    df = spark.createDataFrame([tuple(r[f] for f in S.GOLD_SCHEMA.fieldNames()) for r in full], S.GOLD_SCHEMA)
    publish_buckets(df, root, S.GOLD_KEY, n, keep)


def check(spark, gold_root, view_root):
    gold = read_gold(spark, gold_root)
    assert sorted(map(str, V.read_view(spark, view_root).select(*V.GRAIN, *V.TOTALS).collect())) \
        == sorted(map(str, V.totals(gold).collect()))
    for city in ("all", "A", "nowhere"):
        for beds in (None, [1, 3]):
            view, some = V.read_view(spark, view_root, city, beds), M.filter_listings(gold, city=city, bedrooms=beds)
            assert V.kpis(view).collect() == M.listing_kpis(some).collect()
            assert V.share_two_way(view).collect() == M.share_two_way(some, "has_legal_docs").collect()
            for value in ("price", "price_per_m2"):
                for key in ("district", "city"):
                    a, b = (f.collect() for f in (V.topk_mean(view, key, value, 3), M.topk_mean(some, key, value, 3)))
                    assert [r[0] for r in a] == [r[0] for r in b]
                    assert [r[1] for r in a] == pytest.approx([r[1] for r in b])


def buckets_of(spark, rows, n=16):
    from homestead.sources.tables import bucket_of
    df = spark.createDataFrame([(r["url"],) for r in rows], "url string")
    return {r.url: r.b for r in df.select("url", bucket_of("url", n).alias("b")).collect()}


def test_maintained_equals_recomputed_over_changes(spark):
    gold, view = (f"{scratch()}/{x}" for x in ("gold", "view"))
    assert V.refresh(spark, gold, view).version == 0                       # no gold, no view
    rows = [listing(i, "AB"[i % 2], None if i % 11 == 0 else f"d{i % 5}", float("nan") if i % 13 == 0 else 0.1 * i,
                    None if i % 17 == 0 else i % 4, i % 2) for i in range(200)]
    place = buckets_of(spark, rows)
    publish(spark, gold, rows)
    first = V.refresh(spark, gold, view)
    assert first.whole and len(first.read) == 16
    check(spark, gold, view)
    assert V.refresh(spark, gold, view) == V.Refresh(1, [], False)         # nothing new: nothing read
    one = place["u5"]                                                      # a price changes, a listing moves, one goes
    mine = [dict(r) for r in rows if place[r["url"]] == one]
    mine[0]["price"], mine[1]["district"] = 1e6 / 3, "elsewhere"
    publish(spark, gold, mine[:-1])
    second = V.refresh(spark, gold, view)
    assert not second.whole and sorted(p.rsplit("=", 1)[1] for p in second.read) == [one, one]
    check(spark, gold, view)


def test_catches_up_on_several_runs_and_on_removed_copies(spark):
    gold, view = (f"{scratch()}/{x}" for x in ("gold", "view"))
    rows = [listing(i, price=float(i)) for i in range(40)]
    place = buckets_of(spark, rows, 4)
    b = place["u0"]
    publish(spark, gold, rows, 4, keep=9)
    V.refresh(spark, gold, view)
    for k in (2.0, 3.0):
        publish(spark, gold, [dict(r, price=k) for r in rows if place[r["url"]] == b], 4, keep=9)
    assert not V.refresh(spark, gold, view).whole                          # two runs at once
    check(spark, gold, view)
    publish(spark, gold, [dict(r, price=5.0) for r in rows if place[r["url"]] == b], 4, keep=9)
    remove_superseded(spark, gold, 1)
    assert V.refresh(spark, gold, view).whole                              # the old copy is gone
    check(spark, gold, view)


def test_group_without_listings_goes_and_values_out_of_range_raise(spark):
    gold, view = (f"{scratch()}/{x}" for x in ("gold", "view"))
    publish(spark, gold, [listing(1, district="x"), listing(2, district="y")], 1)
    V.refresh(spark, gold, view)
    publish(spark, gold, [listing(1, district="x")], 1)
    V.refresh(spark, gold, view)
    assert [r.district for r in V.read_view(spark, view).collect()] == ["x"]
    publish(spark, gold, [listing(1, price=1e30)], 1)
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|out of range"):
        V.refresh(spark, gold, view)


def test_of_two_refreshes_one_fails(spark):
    gold, view = (f"{scratch()}/{x}" for x in ("gold", "view"))
    publish(spark, gold, [listing(1)], 1)
    V.refresh(spark, gold, view)
    parts = V.totals(read_gold(spark, gold))
    with pytest.raises(PublishConflict):
        publish_version(parts, view, base=0, note={"buckets": {}})
    check(spark, gold, view)
