"""Crawl rounds composed from the frontier, keyed and extraction operators."""

import datetime as dt

from homestead import schemas as S
from homestead.operators import frontier as FR
from homestead.plans.crawl import link_round, run_detail_round

DOMAIN = "https://site.example"
LISTING = '<div><a class="L" href="/can-ho-{a}">a</a><a class="L" href="{d}/can-ho-{b}">b</a>' \
          '<a class="L" href="https://elsewhere.example/x">c</a><a href="/nav">n</a></div>'


def test_link_round(spark):
    locs = FR.locations(spark, DOMAIN)
    names = [r.name for r in locs.collect()]
    state = spark.createDataFrame([(names[0], 3), (names[1], 7)], S.CRAWL_STATE_SCHEMA)
    frontier = spark.createDataFrame([(f"{DOMAIN}/can-ho-1", "crawled", dt.datetime(2026, 1, 1))],
                                     S.FRONTIER_SCHEMA)
    cur = {r.name: r.page_url for r in FR.page_urls(FR.current_pages(locs, state)).collect()}
    assert cur[names[0]].endswith("/p3") and cur[names[2]] == DOMAIN + FR.LOCATIONS[2][1]
    pages = spark.createDataFrame([
        (1, cur[names[0]], LISTING.format(a=1, b=2, d=DOMAIN)),
        (2, cur[names[1]], "<p>no listings</p>"),
        (3, cur[names[2]], LISTING.format(a=2, b=3, d=DOMAIN)),
    ], S.PAGES_SCHEMA)
    r = link_round(locs, state, frontier, pages, DOMAIN, link_class="L")
    got = {x.url: x.status for x in r.frontier.collect()}
    assert got == {f"{DOMAIN}/can-ho-1": "crawled", f"{DOMAIN}/can-ho-2": "pending",
                   f"{DOMAIN}/can-ho-3": "pending"}
    st = {x.location_name: x.current_page for x in r.state.collect()}
    assert st[names[0]] == 4 and st[names[1]] == 1 and st[names[2]] == 2
    assert [x.page_id for x in r.quarantine.collect()] == [2]
    nxt = {x.name: x.page_url for x in r.page_urls.collect()}
    assert nxt[names[0]].endswith("/p4") and nxt[names[1]] == DOMAIN + FR.LOCATIONS[1][1]


def test_detail_round(spark, tmp_path):
    frontier = spark.createDataFrame([
        (f"{DOMAIN}/a", "pending", dt.datetime(2026, 1, 1)),
        (f"{DOMAIN}/b", "pending", dt.datetime(2026, 1, 2)),
        (f"{DOMAIN}/c", "pending", dt.datetime(2026, 1, 3)),
    ], S.FRONTIER_SCHEMA)
    good = '<h1 class="re__pr-title">Căn hộ</h1><span class="re__address-line-2">(Phường A, HN)</span>'
    pages = spark.createDataFrame([
        (1, f"{DOMAIN}/a", good), (2, f"{DOMAIN}/b", "<p>blocked</p>"), (3, f"{DOMAIN}/c", good),
    ], S.PAGES_SCHEMA)
    r = run_detail_round(frontier, pages, 2, f"{tmp_path}/bronze", crawled_at="2026-05-01 10:00:00")
    assert [x.url for x in r.bronze.collect()] == [f"{DOMAIN}/a"]
    assert r.bronze.first().address_line_2 == "Phường A, HN"
    assert [x.url for x in r.rejected.collect()] == [f"{DOMAIN}/b"]
    st = {x.url: x.status for x in r.frontier.collect()}
    assert st == {f"{DOMAIN}/a": "crawled", f"{DOMAIN}/b": "pending", f"{DOMAIN}/c": "pending"}


def test_detail_round_is_idempotent(spark, tmp_path):
    """The queue has no claim step: a url taken twice must not change the
    outcome (keyed status update, keyed gold upsert)."""
    frontier = spark.createDataFrame([(f"{DOMAIN}/a", "pending", dt.datetime(2026, 1, 1))], S.FRONTIER_SCHEMA)
    good = '<h1 class="re__pr-title">Căn hộ</h1>'
    pages = spark.createDataFrame([(1, f"{DOMAIN}/a", good)], S.PAGES_SCHEMA)
    once = run_detail_round(frontier, pages, 1, f"{tmp_path}/bronze", crawled_at="2026-05-01 10:00:00").frontier
    from homestead.operators.frontier import mark_crawled
    twice = mark_crawled(once, spark.createDataFrame([(f"{DOMAIN}/a",)], "url string"))
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
