"""What keeps the listing queries' time and disk in proportion to their input."""
import os
import random

import pytest
from pyspark.sql import functions as F

from homestead.operators import extract as E
from homestead.plans import catalog as C
from homestead.plans.etl import read_gold, run_etl
from homestead.plans.listings import listing_bronze
from homestead.session import scratch_path, settings
from homestead.sources.bronze import land_bronze, read_bronze
from homestead.sources.tables import committed_versions
from homestead.streaming import ingest as I
from test_io_stream import DOC, FIXTURE_HTML, SPEC, write_docs

SF = "/root/testdata/sf0.001"


def _files(root, day="dt="):
    return [os.path.join(d, f) for d, _, fs in os.walk(root.replace("file:", "")) if day in d for f in fs if f.startswith("part-")]


def _lines(df):
    return sorted(map(str, df.select("url", "title", "address", "address_line_2", "short_info", "specs", "crawled_at").collect()))


def test_gold_is_rewritten_a_few_times_for_many_micro_batches(spark):
    root = scratch_path(spark, "scale")
    for i in range(6):
        write_docs(f"{root}/bronze".replace("file:", ""), f"2026-06-{i + 1:02d}",
                   [dict(DOC, url=f"https://site.example/{i % 4}", crawled_at=f"2026-05-{20 - i}T10:00:00")])
    stamp = "2026-06-01 02:00:00"
    I.stream_to_gold(spark, f"{root}/bronze", f"{root}/silver", f"{root}/gold", f"{root}/ck", 1, loaded_at=stamp)
    assert len(committed_versions(spark, f"{root}/gold")) == 4              # batches 0, 1, 2-3 and the rest
    run_etl(spark, f"{root}/bronze", f"{root}/silver2", f"{root}/gold2", loaded_at=stamp)
    one, two = (sorted(map(str, read_gold(spark, f"{root}/{g}").collect())) for g in ("gold", "gold2"))
    assert one == two and len(one) == 4


def test_next_pass_upserts_what_a_lost_one_left_in_silver(spark, monkeypatch):
    root = scratch_path(spark, "scale")
    args = (spark, f"{root}/bronze", f"{root}/silver", f"{root}/gold", f"{root}/ck", 1)
    for i in range(3):
        write_docs(f"{root}/bronze".replace("file:", ""), f"2026-06-0{i + 1}", [dict(DOC, url=f"https://site.example/{i}")])
    upsert = I.upsert_batch

    def lost(silver, number, *rest):
        if number == 2:
            raise RuntimeError("lost")
        return upsert(silver, number, *rest)
    monkeypatch.setattr(I, "upsert_batch", lost)
    with pytest.raises(RuntimeError):
        I.stream_to_gold(*args)
    assert read_gold(spark, f"{root}/gold").count() == 2
    monkeypatch.undo()
    I.stream_to_gold(*args)
    assert read_gold(spark, f"{root}/gold").count() == 3


def test_a_landing_of_the_streams_is_one_file_whatever_the_partition_size(spark):
    with settings(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k"}):
        root = C._landed_by_line(spark, SF, "scale", 2)
    assert [len(_files(f"{root}/bronze", f"dt=2026-01-0{d}")) for d in (1, 2, 3, 4)] == [1, 1, 1, 1]
    assert _lines(read_bronze(spark, f"{root}/bronze")) == _lines(listing_bronze(spark, SF))


def test_landed_months_are_compressed_and_whole(spark):
    root = C._landed(spark, SF, "scale")
    files = _files(f"{root}/bronze")
    assert files and all(f.endswith(".json.gz") for f in files)
    assert _lines(read_bronze(spark, f"{root}/bronze")) == _lines(listing_bronze(spark, SF))


def test_documents_are_not_shuffled_to_be_landed_on_one_day(spark):
    docs = spark.createDataFrame([(f"u{i}", "2026-05-01T10:00:00") for i in range(40)], "url string, crawled_at string").repartition(4)
    for day, clustered, files in (("2026-05-01", True, 4), (None, True, 4), ("2026-05-01", False, 1)):
        root = scratch_path(spark, "scale")
        land_bronze(docs, root, day=day, compression="gzip", clustered=clustered)
        assert len(_files(root)) == files and read_bronze(spark, root).filter("dt = date'2026-05-01'").count() == 40


def test_lineitem_is_shuffled_once_for_its_documents(spark):
    plan = listing_bronze(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    assert "l_orderkey" in joins[0] and "o_orderkey" in joins[0]            # the outermost join is lineitem's only one


PLAIN = FIXTURE_HTML.replace("<title>", "<b>").replace("</title>", "</b>")


def test_plain_pages_need_no_tree_and_odd_ones_get_it(spark, monkeypatch):
    tree = lambda html: _by_tree(html, SPEC, monkeypatch)
    want = tree(PLAIN)
    with monkeypatch.context() as m:
        m.setattr(E, "parse_html", None)
        page = C.listing_pages(spark, SF).first().html
        assert E.extract_page(page, E.PageSpec())["links"]
        assert E.extract_page(PLAIN, SPEC) == want
    rng, tags = random.Random(7), sorted({v for v in vars(E.PageSpec()).values()})
    odd = ["<br>", "<br/>", "a &amp; b", "&copy", " x ", "<!-- - c -->", "<!-->", "<script>'<i>'</script>", "<script></p></script>",
           "<title>t<b></title>", "<a href=x&amp=1>", "<A HREF=/u/ CLASS=ext>", "<a b=\"x>y\">", "<template>", "</template>", "<", "\0",
           "<a href=\"a\"b=\"c\">", "<?x>", "<!x>", "</ a>"]
    for _ in range(3000):
        bits = [rng.choice([*odd, *(f'<{t} class="y {c}">' for t, c in tags), *(f"</{t}>" for t, _ in tags)]) for _ in range(rng.randint(0, 12))]
        html = "".join(bits)
        assert E.extract_page(html, E.PageSpec()) == _by_tree(html, E.PageSpec(), monkeypatch), html


def _by_tree(html, spec, monkeypatch):
    with monkeypatch.context() as m:
        m.setattr(E, "_scan", lambda _: None)
        return E.extract_page(html, spec)


def test_only_wanted_fields_are_extracted(spark):
    pages = spark.createDataFrame([(1, "u", FIXTURE_HTML), (2, "v", "<p>x</p>"), (3, "w", None)], "page_id long, url string, html string")
    some = E.extract_documents(pages, SPEC, fields=("has_title", "links"))
    assert some.columns == ["page_id", "url", "has_title", "links"]
    whole = E.extract_documents(pages, SPEC)
    assert sorted(map(str, some.collect())) == sorted(map(str, whole.select(*some.columns).collect()))
    assert sorted(r.page_id for r in E.rejected_pages(some).collect()) == [2, 3]
