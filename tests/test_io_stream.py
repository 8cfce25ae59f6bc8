"""Bronze landing and scan, partitioned writes, versioned gold, the ETL run,
HTML extraction and the streaming ingest."""

import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from homestead import schemas as S
from homestead.operators import extract as E
from homestead.plans.etl import EmptySourceError, run_etl, run_silver_to_gold
from homestead.sources.bronze import corrupt_rows, land_bronze, read_bronze
from homestead.sources.tables import committed_versions, read_partitioned, read_versioned, write_partitioned
from homestead.streaming.ingest import first_per_key_stream, ingest_bronze_stream

DOC = {"url": "https://site.example/can-ho-a-pr1", "title": "Căn hộ A",
       "address": "12/3, Khu Đô Thị Xanh, Phường Long Bình",
       "address_line_2": "Phường Long Bình, Hồ Chí Minh mới",
       "short_info": {"Khoảng giá": "3,5 tỷ", "Khoảng giá(ext)": "~67,5 triệu/m²", "Diện tích": "52 m²",
                      "Phòng ngủ": "2 PN", "Ngày đăng": "01/05/2026", "Ngày hết hạn": "16/05/2026"},
       "specs": {"Số phòng ngủ": "2 phòng", "Hướng nhà": "Đông", "Pháp lý": "Sổ đỏ/ Sổ hồng"},
       "description": "Mô tả", "crawled_at": "2026-05-01T10:00:00.123456"}


def scratch():
    return tempfile.mkdtemp(prefix="homestead-test-", dir="/tmp")


def write_docs(root, day, docs, extra_lines=()):
    d = os.path.join(root, f"dt={day}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, "part-0.json"), "w", encoding="utf-8") as f:
        for doc in docs:
            f.write(json.dumps(doc, ensure_ascii=False) + "\n")
        for line in extra_lines:
            f.write(line + "\n")


def bronze_docs():
    second = dict(DOC, crawled_at="2026-05-02T09:00:00", short_info=dict(DOC["short_info"], **{"Khoảng giá": "3,7 tỷ"}))
    other = dict(DOC, url="https://site.example/b-pr2", address_line_2="Quận 1, Hà Nội",
                 crawled_at="2026-05-01T11:00:00")
    blank = dict(DOC, url="https://site.example/c-pr3", title="  ")
    oneline = dict(DOC, url="https://site.example/d-pr4", address_line_2="Phường X")
    ward = dict(DOC, url="https://site.example/e-pr5", address_line_2="Quận Phường Y, Đà Nẵng cũ",
                specs={}, short_info={}, crawled_at="2026-05-01T12:00:00")
    return [DOC, other, blank, oneline, ward], [second]


def test_bronze_scan_and_silver_gold_golden(spark):
    root = scratch()
    day1, day2 = bronze_docs()
    write_docs(f"{root}/bronze", "2026-05-01", day1, extra_lines=["{nope"])
    write_docs(f"{root}/bronze", "2026-05-02", day2)
    b = read_bronze(spark, f"{root}/bronze")
    assert len(corrupt_rows(b).collect()) == 1
    counts = run_etl(spark, f"{root}/bronze", f"{root}/silver", f"{root}/gold",
                     loaded_at="2026-06-01 02:00:00")
    assert (counts.bronze_rows, counts.corrupt_rows, counts.silver_rows) == (7, 1, 3)
    silver = read_partitioned(spark, f"{root}/silver")
    assert sorted(r.district for r in silver.collect()) == ["Phường Long Bình", "Phường Long Bình", "Phường Y"]
    gold = read_versioned(spark, f"{root}/gold")
    rows = {r.url: r for r in gold.collect()}
    assert set(rows) == {DOC["url"], "https://site.example/e-pr5"}
    a = rows[DOC["url"]]
    assert a.price == 3.7 and a.area_m2 == 52.0 and a.price_per_m2 == 67.5
    assert a.num_bedrooms == 2 and a.has_legal_docs == 1 and a.project_name == "Khu Đô Thị Xanh"
    assert a.city == "Hồ Chí Minh" and a.posted_date == dt.date(2026, 5, 1) and a.dt == dt.date(2026, 5, 2)
    e = rows["https://site.example/e-pr5"]
    assert e.price is None and e.num_bedrooms is None and e.has_legal_docs == 0 and e.city == "Đà Nẵng"
    assert counts.gold_rows == 2
    bad = spark.read.parquet(f"{root}/silver_quarantine").collect()
    assert [(r._corrupt_record, str(r.load)) for r in bad] == [("{nope", "2026-05-01")]
    # second run with the same silver: upsert is idempotent, a new version is published
    c2 = run_silver_to_gold(spark, f"{root}/silver", f"{root}/gold", loaded_at="2026-06-02 02:00:00")
    assert c2.gold_rows == 2 and committed_versions(spark, f"{root}/gold") == [1, 2]


def test_empty_source_raises(spark):
    root = scratch()
    os.makedirs(f"{root}/bronze")
    with pytest.raises(EmptySourceError):
        run_etl(spark, f"{root}/bronze", f"{root}/silver", f"{root}/gold")
    with pytest.raises(EmptySourceError):
        run_etl(spark, f"{root}/missing", f"{root}/silver", f"{root}/gold")


def test_partition_overwrite_modes_and_null_dt(spark):
    root = scratch()
    days = [dt.date(2026, 5, d) for d in (1, 2, 3)]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "id int, dt date")
    write_partitioned(df, f"{root}/t")
    one = spark.createDataFrame([(9, days[0])], "id int, dt date")
    write_partitioned(one, f"{root}/t", dynamic=True)
    assert sorted(r.id for r in spark.read.parquet(f"{root}/t").collect()) == [1, 2, 9]
    write_partitioned(one, f"{root}/t", dynamic=False)
    assert [r.id for r in spark.read.parquet(f"{root}/t").collect()] == [9]
    nul = spark.createDataFrame([(1, None)], "id int, dt date")
    write_partitioned(nul, f"{root}/n")
    assert os.path.isdir(f"{root}/n/dt=__HIVE_DEFAULT_PARTITION__")
    assert spark.read.parquet(f"{root}/n").first().dt is None
    pruned = read_partitioned(spark, f"{root}/t", since="2026-05-02")
    assert "PartitionFilters: [isnotnull(dt" in pruned._jdf.queryExecution().executedPlan().toString()


def test_land_bronze_same_day_last_wins(spark):
    root = scratch()
    docs = spark.createDataFrame(
        [("u1", "t", "2026-05-01T10:00:00"), ("u1", "t2", "2026-05-01T11:00:00"), ("u1", "t3", "2026-05-02T01:00:00")],
        "url string, title string, crawled_at string")
    land_bronze(docs, f"{root}/b", same_day_last_wins=True)
    got = sorted((str(r.dt), r.title) for r in read_bronze(spark, f"{root}/b").collect())
    assert got == [("2026-05-01", "t2"), ("2026-05-02", "t3")]


FIXTURE_HTML = """<html><body>
<h1 class="T big"> Căn hộ A </h1><span class="A1">12/3, Khu Đô Thị Xanh</span><span class="A2">(Phường X, Hà Nội)</span>
<div class="S"><span class="title">Khoảng giá</span><span class="value">3,5 tỷ</span><span class="ext">~67 triệu/m²</span></div>
<div class="S"><span class="title">Diện tích</span><span class="value">52 m²</span></div>
<div class="S"><span class="title">Bỏ</span></div>
<div class="P"><span class="P-title">Pháp lý</span><span class="P-value">Sổ đỏ</span></div>
<div class="D">line one<br>line two<script>var x="<b>";</script></div>
<a class="L" href="/p1">x</a><a class="L other" href="https://other.example/y">y</a><a href="/skip">z</a>
</body></html>"""

SPEC = E.PageSpec(title=("h1", "T"), address_1=("span", "A1"), address_2=("span", "A2"),
                  short_item=("div", "S"), spec_item=("div", "P"), spec_label=("span", "P-title"),
                  spec_value=("span", "P-value"), description=("div", "D"), link=("a", "L"))


def test_extract_page_fixture():
    got = E.extract_page(FIXTURE_HTML, SPEC)
    assert got["title"] == "Căn hộ A" and got["has_title"]
    assert got["address"] == "12/3, Khu Đô Thị Xanh"
    assert got["address_line_2"] == "Phường X, Hà Nội"
    assert dict(got["short_info"]) == {"Khoảng giá": "3,5 tỷ", "Khoảng giá(ext)": "~67 triệu/m²", "Diện tích": "52 m²"}
    assert dict(got["specs"]) == {"Pháp lý": "Sổ đỏ"}
    assert got["description"] == "line one\nline two"
    assert got["links"] == ["/p1", "https://other.example/y"]
    assert E.extract_page("<html><p>blocked</p></html>", SPEC)["has_title"] is False


def test_extract_documents_to_silver(spark):
    pages = spark.createDataFrame([(1, "https://site.example/a-pr1", FIXTURE_HTML),
                                   (2, "https://site.example/b", "<p>captcha</p>")], S.PAGES_SCHEMA)
    ext = E.extract_documents(pages, SPEC)
    assert E.rejected_pages(ext).count() == 1
    bronze = E.bronze_from_pages(ext, crawled_at="2026-05-01 10:00:00")
    from homestead.plans.silver import bronze_to_silver
    s = bronze_to_silver(bronze).collect()
    assert len(s) == 1 and s[0].price == 3.5 and s[0].district == "Phường X" and s[0].city == "Hà Nội"
    links = E.extract_links(pages, domain="https://site.example", cls="L").collect()
    assert [r.link for r in links] == ["https://site.example/p1"]


def test_attribute_values_hold_no_attributes(spark):
    """The built-in path and the parser agree on names inside quoted values."""
    tags = ["""<a title=" href='x'" href="/y">l</a>""", """<a data-q='a href="n" b' class="L" HREF=/u>l</a>""",
            """<a title=">" href='/g?a=1&amp;b=2'>l</a>""", """<a hreflang="en" data-href="/no" href = "/s p">l</a>""",
            """<a title="href=/no">l</a>""", """<a href="">l</a>""", "<a\nhref='/nl'\ntitle=\"t\">l</a>"]
    pages = spark.createDataFrame([(i, f"https://site.example/{i}", t) for i, t in enumerate(tags)], S.PAGES_SCHEMA)
    parsed = {r.page_id: list(r.links) for r in E.extract_documents(pages, E.PageSpec(title=("h1", None), link=("a", None))).collect()}
    built_in = {r.page_id: list(r.links) for r in pages.select("page_id", E.anchor_hrefs("html").alias("links")).collect()}
    assert built_in == {0: ["/y"], 1: ["/u"], 2: ["/g?a=1&b=2"], 3: ["/s p"], 4: [], 5: [], 6: ["/nl"]}
    assert {k: [x for x in v if x] for k, v in parsed.items()} == built_in


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_parser_agrees_with_regex_path_on_driver_pages(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    spec = E.PageSpec(title=("h1", None), link=("a", None))
    parsed = E.extract_documents(pages, spec).select("page_id", "title", F.size("links").alias("n"))
    regex = pages.select("page_id", E.first_tag_text("html", "h1").alias("title2"),
                         F.size(E.anchor_hrefs("html")).alias("n2"))
    j = parsed.join(regex, "page_id")
    assert j.filter((F.col("title") != F.col("title2")) | (F.col("n") != F.col("n2"))).count() == 0


def test_stream_equals_batch_and_rerun_adds_nothing(spark):
    root = scratch()
    day1, day2 = bronze_docs()
    write_docs(f"{root}/bronze", "2026-05-01", day1)
    ingest_bronze_stream(spark, f"{root}/bronze", f"{root}/silver", f"{root}/ck")
    first = spark.read.parquet(f"{root}/silver").count()
    write_docs(f"{root}/bronze", "2026-05-02", day2)
    ingest_bronze_stream(spark, f"{root}/bronze", f"{root}/silver", f"{root}/ck")
    ingest_bronze_stream(spark, f"{root}/bronze", f"{root}/silver", f"{root}/ck")
    from homestead.plans.silver import bronze_to_silver
    batch = bronze_to_silver(read_bronze(spark, f"{root}/bronze")).select(*S.SILVER_COLUMNS)
    stream = spark.read.parquet(f"{root}/silver").select(*S.SILVER_COLUMNS)
    assert first == 2
    assert sorted(map(tuple, stream.collect()), key=repr) == sorted(map(tuple, batch.collect()), key=repr)


def _out_of_order_files(root):
    """Four files: urls a, b, a, c; their dates out of order; one corrupt line."""
    for i, (name, when) in enumerate((("a", "2026-05-20T10:00:00"), ("b", "2026-05-21T10:00:00"),
                                      ("a", "2026-05-22T10:00:00"), ("c", "2026-05-01T10:00:00"))):
        write_docs(f"{root}/bronze", f"2026-06-0{i + 1}", [dict(DOC, url=f"https://site.example/{name}", crawled_at=when)],
                   extra_lines=["{nope"] if i == 1 else ())


@pytest.mark.parametrize("files", [1, 1000])
def test_streams_lose_nothing_whatever_the_batch_size(spark, files):
    root = scratch()
    _out_of_order_files(root)
    first_per_key_stream(spark, f"{root}/bronze", f"{root}/once", f"{root}/ck1", max_files_per_trigger=files)
    urls = sorted(r.url[-1] for r in spark.read.parquet(f"{root}/once").collect())
    assert urls == ["a", "b", "c"]
    if files == 1:                                         # of url a, the crawl that came first
        assert str(spark.read.parquet(f"{root}/once").filter("url like '%/a'").first().crawled_at) == "2026-05-20 10:00:00"
    ingest_bronze_stream(spark, f"{root}/bronze", f"{root}/silver", f"{root}/ck2", max_files_per_trigger=files,
                         quarantine=f"{root}/bad")
    assert sorted(r.url[-1] for r in spark.read.parquet(f"{root}/silver").collect()) == ["a", "a", "b", "c"]
    assert [r._corrupt_record for r in spark.read.parquet(f"{root}/bad").collect()] == ["{nope"]
    first_per_key_stream(spark, f"{root}/bronze", f"{root}/once", f"{root}/ck1", max_files_per_trigger=files)
    assert spark.read.parquet(f"{root}/once").count() == 3


def test_keys_leave_the_state_after_their_time(spark):
    """A key that comes again after ``keep_days`` is written again: the state is bounded."""
    root = scratch()
    write_docs(f"{root}/bronze", "2026-06-01", [DOC])
    args = (spark, f"{root}/bronze", f"{root}/once", f"{root}/ck")
    first_per_key_stream(*args, keep_days=1e-6)
    write_docs(f"{root}/bronze", "2026-06-02", [dict(DOC, url="https://site.example/other")])
    first_per_key_stream(*args, keep_days=1e-6)            # its timer has run out by now
    write_docs(f"{root}/bronze", "2026-06-03", [DOC])
    first_per_key_stream(*args, keep_days=1e-6)
    assert spark.read.parquet(f"{root}/once").count() == 3


def test_stream_to_gold_equals_batch_and_replays_once(spark):
    from homestead.plans.etl import read_gold
    from homestead.streaming.ingest import stream_to_gold, upsert_batch
    root, full = scratch(), scratch()
    _out_of_order_files(root)
    write_docs(f"{root}/bronze", "2026-06-05", [dict(DOC, url="https://site.example/a", crawled_at=None),
                                                dict(DOC, url="https://site.example/b", crawled_at="2020-01-01T00:00:00")])
    for _ in range(2):
        stream_to_gold(spark, f"{root}/bronze", f"{root}/silver", f"{root}/gold", f"{root}/ck", 2, f"{root}/bad",
                       loaded_at="2026-06-01 02:00:00")
    run_etl(spark, f"{root}/bronze", f"{full}/silver", f"{full}/gold", loaded_at="2026-06-01 02:00:00")
    want = sorted(map(str, read_gold(spark, f"{full}/gold").collect()))
    assert sorted(map(str, read_gold(spark, f"{root}/gold").collect())) == want
    versions = committed_versions(spark, f"{root}/gold")
    silver = spark.read.parquet(f"{root}/silver")
    assert [upsert_batch(silver.filter(F.col("batch") == n), n, f"{root}/gold", loaded_at="2026-06-09 00:00:00") for n in (0, 2)] == [False, False]
    assert upsert_batch(silver.filter("batch = 0"), 0, f"{root}/gold", "another stream", loaded_at="2026-06-01 02:00:00")
    assert sorted(map(str, read_gold(spark, f"{root}/gold").collect())) == want
    assert committed_versions(spark, f"{root}/gold") == versions + [versions[-1] + 1]
    assert [r._corrupt_record for r in spark.read.parquet(f"{root}/bad").collect()] == ["{nope"]


def test_landed_json_keeps_non_ascii(spark):
    root = scratch()
    docs = spark.createDataFrame([("u1", "Căn hộ Đông", "2026-05-01T10:00:00")],
                                 "url string, title string, crawled_at string")
    land_bronze(docs, f"{root}/b")
    files = [os.path.join(dp, f) for dp, _, fs in os.walk(f"{root}/b") for f in fs if f.endswith(".json")]
    text = "".join(open(f, encoding="utf-8").read() for f in files)
    assert "Căn hộ Đông" in text and "\\u" not in text
    assert os.path.isdir(f"{root}/b/dt=2026-05-01")


def test_incremental_run_adds_new_landings(spark):
    """Daily incremental run: silver keeps earlier landings, gold reads only
    what the new ones touch and upserts it."""
    root = scratch()
    day1, day2 = bronze_docs()
    write_docs(f"{root}/bronze1", "2026-05-01", day1)
    run_etl(spark, f"{root}/bronze1", f"{root}/silver", f"{root}/gold", loaded_at="2026-06-01 02:00:00")
    write_docs(f"{root}/bronze2", "2026-05-02", day2)
    from homestead.plans.etl import run_bronze_to_silver
    run_bronze_to_silver(spark, f"{root}/bronze2", f"{root}/silver", incremental=True)
    silver = read_partitioned(spark, f"{root}/silver")
    assert sorted(str(r.dt) for r in silver.collect()) == ["2026-05-01", "2026-05-01", "2026-05-02"]
    c = run_silver_to_gold(spark, f"{root}/silver", f"{root}/gold", loaded_at="2026-06-02 02:00:00",
                           since="2026-05-02")
    assert c.gold_batch_rows == 1 and c.gold_rows == 2
    rows = {r.url: r for r in read_versioned(spark, f"{root}/gold").collect()}
    assert rows[DOC["url"]].price == 3.7
    assert str(rows[DOC["url"]].gold_loaded_at) == "2026-06-02 02:00:00"
    assert str(rows["https://site.example/e-pr5"].gold_loaded_at) == "2026-06-01 02:00:00"


def test_daily_gold_merge_streams_gold_through_broadcast_anti_join(spark):
    from homestead.plans.etl import plan_gold_merge
    root = scratch()
    day1, day2 = bronze_docs()
    write_docs(f"{root}/bronze", "2026-05-01", day1)
    run_etl(spark, f"{root}/bronze", f"{root}/silver", f"{root}/gold", loaded_at="2026-06-01 02:00:00")
    plan = plan_gold_merge(spark, f"{root}/silver", f"{root}/gold", loaded_at="2026-06-02 02:00:00",
                           since="2026-05-01")
    assert plan.broadcast_keys
    plan.merged.write.format("noop").mode("overwrite").save()
    phys = plan.merged._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in phys and "LeftAnti" in phys and "SortMergeJoin" not in phys


def test_late_document_joins_its_date_and_keeps_newer_gold(spark):
    root = scratch()
    args = (f"{root}/bronze", f"{root}/silver", f"{root}/gold")
    day1, day2 = bronze_docs()
    write_docs(f"{root}/bronze", "2026-05-02", day1 + day2)
    run_etl(spark, *args, loaded_at="2026-06-01 02:00:00")
    late = [dict(DOC, crawled_at="2026-05-01T23:59:59", short_info=dict(DOC["short_info"], **{"Khoảng giá": "9,9 tỷ"})),
            dict(DOC, url="https://site.example/z", crawled_at="2026-05-01T23:59:59")]
    write_docs(f"{root}/bronze", "2026-05-03", late)
    for _ in range(2):                                     # a rerun replaces its own rows
        run_etl(spark, *args, loaded_at="2026-06-02 02:00:00", incremental=True, since="2026-05-03")
        silver = read_partitioned(spark, f"{root}/silver")
        assert silver.count() == 5 and silver.filter("dt = date'2026-05-01'").count() == 4
        gold = {r.url: r for r in read_versioned(spark, f"{root}/gold").collect()}
        assert len(gold) == 3 and gold[DOC["url"]].price == 3.7 and str(gold[DOC["url"]].dt) == "2026-05-02"
    full = scratch()
    run_etl(spark, args[0], f"{full}/silver", f"{full}/gold", loaded_at="2026-06-01 02:00:00")
    one, two = (sorted(map(str, read_partitioned(spark, f"{r}/silver").select(*S.SILVER_COLUMNS).collect())) for r in (root, full))
    assert one == two


def test_corrupt_only_input_keeps_silver(spark):
    root = scratch()
    day1, _ = bronze_docs()
    write_docs(f"{root}/bronze", "2026-05-01", day1)
    run_etl(spark, f"{root}/bronze", f"{root}/silver", f"{root}/gold", loaded_at="2026-06-01 02:00:00")
    before = read_partitioned(spark, f"{root}/silver").count()
    write_docs(f"{root}/bad", "2026-05-02", [], extra_lines=["{nope"])
    write_docs(f"{root}/unfit", "2026-05-02", [dict(DOC, title=" ")])
    for source in ("bad", "unfit"):
        with pytest.raises(EmptySourceError):
            run_etl(spark, f"{root}/{source}", f"{root}/silver", f"{root}/gold")
        assert read_partitioned(spark, f"{root}/silver").count() == before
    assert spark.read.parquet(f"{root}/silver_quarantine").count() == 1


def test_null_url_never_reaches_gold(spark):
    root = scratch()
    write_docs(f"{root}/bronze", "2026-05-01", [DOC, dict(DOC, url=None)])
    for _ in range(2):
        run_etl(spark, f"{root}/bronze", f"{root}/silver", f"{root}/gold", loaded_at="2026-06-01 02:00:00")
        assert [r.url for r in read_versioned(spark, f"{root}/gold").collect()] == [DOC["url"]]


def test_upsert_of_one_url_rewrites_one_bucket(spark):
    from homestead.sources.tables import PublishConflict, publish_buckets
    root = scratch()
    docs = [dict(DOC, url=f"https://site.example/{i}") for i in range(200)]
    write_docs(f"{root}/bronze", "2026-05-01", docs)
    args = (f"{root}/bronze", f"{root}/silver", f"{root}/gold")
    run_etl(spark, *args, loaded_at="2026-06-01 02:00:00")
    assert len([d for d in os.listdir(f"{root}/gold/v=1") if d.startswith("bucket=")]) > 50
    write_docs(f"{root}/bronze", "2026-05-02", [dict(DOC, url="https://site.example/7", crawled_at="2026-05-02T00:00:00")])
    c = run_etl(spark, *args, loaded_at="2026-06-02 02:00:00", incremental=True, since="2026-05-02")
    assert len([d for d in os.listdir(f"{root}/gold/v=2") if d.startswith("bucket=")]) == 1 and c.gold_rows == 200
    new = {r.url: str(r.dt) for r in read_versioned(spark, f"{root}/gold").collect()}
    assert len(new) == 200 and [u for u, d in new.items() if d == "2026-05-02"] == ["https://site.example/7"]
    for day in (3, 4):                                     # superseded copies go, the newest two stay
        write_docs(f"{root}/bronze", f"2026-05-0{day}", [dict(DOC, url="https://site.example/7", crawled_at=f"2026-05-0{day}T00:00:00")])
        run_etl(spark, *args, loaded_at="2026-06-02 02:00:00", incremental=True, since=f"2026-05-0{day}")
    name = [d for d in os.listdir(f"{root}/gold/v=4") if d.startswith("bucket=")][0]
    assert [os.path.isdir(f"{root}/gold/v={v}/{name}") for v in (1, 2, 3, 4)] == [False, False, True, True]
    assert read_versioned(spark, f"{root}/gold").count() == 200
    open(f"{root}/gold/_publishing-5", "w").close()
    with pytest.raises(PublishConflict):
        publish_buckets(read_versioned(spark, f"{root}/gold"), f"{root}/gold", "url", 64)
    assert committed_versions(spark, f"{root}/gold") == [1, 2, 3, 4]


def test_gold_scan_is_pruned(spark):
    from homestead.plans.gold import silver_to_gold
    root = scratch()
    day1, _ = bronze_docs()
    write_docs(f"{root}/bronze", "2026-05-01", day1)
    run_etl(spark, f"{root}/bronze", f"{root}/silver", f"{root}/gold", loaded_at="2026-06-01 02:00:00")
    plan = silver_to_gold(read_partitioned(spark, f"{root}/silver"))._jdf.queryExecution().executedPlan().toString()
    schema = plan[plan.index("ReadSchema"):]
    assert "title" in schema and "description" not in schema and "price_raw" not in schema
