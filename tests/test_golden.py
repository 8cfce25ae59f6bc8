"""Golden edge cases: one-row inputs with a known output (ANSI mode on)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from homestead.functions import predicates as P
from homestead.functions import text as X


def one(spark, value, fn, dtype="string"):
    df = spark.createDataFrame([(value,)], f"v {dtype}")
    return df.select(fn(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("text,expected", [
    ("3,5 tỷ", 3.5), ("850 triệu", 850.0), ("1.234,5 m²", 1234.5), ("75 m2", 752.0),
    ("2 - 3 tỷ", 23.0), ("1,5 - 2,5 tỷ", None), ("Thỏa thuận", None), (None, None),
])
def test_locale_number(spark, text, expected):
    assert one(spark, text, X.locale_number) == expected


@pytest.mark.parametrize("text,expected", [("3 PN", 3), ("Không", None), ("", None), (None, None)])
def test_digits_int(spark, text, expected):
    assert one(spark, text, X.digits_int) == expected


@pytest.mark.parametrize("text,expected", [
    ("01/05/2026", dt.date(2026, 5, 1)), ("1/5/2026", None), ("2026-05-01", None), (None, None),
])
def test_parse_date(spark, text, expected):
    assert one(spark, text, X.parse_date) == expected


@pytest.mark.parametrize("text,ok", [
    ("2026-05-01T10:00:00", True), ("2026-05-01T10:00:00.123456", True), ("nope", False),
])
def test_parse_timestamp(spark, text, ok):
    assert (one(spark, text, X.parse_timestamp) is not None) == ok


@pytest.mark.parametrize("text,expected", [
    ("Quận 1", "1"), ("Quận Phường X", "Phường X"), ("Thị Xã Y", "Thị Xã Y"), ("Huyện  A", "A"),
])
def test_strip_district_prefix(spark, text, expected):
    assert one(spark, text, X.strip_district_prefix) == expected


def test_strip_city_suffix(spark):
    assert one(spark, "Hồ Chí Minh mới", X.strip_city_suffix) == "Hồ Chí Minh"
    assert one(spark, "Hà Nội cũ", X.strip_city_suffix) == "Hà Nội"


def test_ward_filter_nfd_does_not_match(spark):
    import unicodedata
    nfd = unicodedata.normalize("NFD", "Phường A")
    assert one(spark, nfd, P.is_ward) is False
    assert one(spark, "Phường A", P.is_ward) is True
    assert one(spark, "1", P.is_ward) is False


@pytest.mark.parametrize("text,expected", [(None, False), ("Phường A", False), ("Phường A, HN", True)])
def test_min_parts(spark, text, expected):
    assert one(spark, text, P.min_parts) is expected


@pytest.mark.parametrize("text,expected", [
    (None, 0), ("Chưa có Sổ", 1), ("Sổ đỏ/ Sổ hồng", 1), ("Hợp đồng", 0),
])
def test_keyword_flag(spark, text, expected):
    assert one(spark, text, X.keyword_flag) == expected


@pytest.mark.parametrize("text,expected", [
    ("123, Vinhomes Grand Park, Phường A", "Vinhomes Grand Park"),
    ("Số 5 Lê Lợi, Đường X", "Đường X"),
    ("Masteri, Q9", "Masteri"),
    ("12/3 A, B", None),
    (None, None),
])
def test_first_meaningful_part(spark, text, expected):
    assert one(spark, text, X.first_meaningful_part) == expected


def test_map_lookup_missing(spark):
    df = spark.createDataFrame([({"a": "1"},), ({},)], "m map<string,string>")
    assert [r[0] for r in df.select(X.map_field("m", "b")).collect()] == [None, None]


def test_struct_or_map_field_tolerates_missing(spark):
    df = spark.createDataFrame([(("x",),)], "s struct<a:string>")
    assert df.select(X.struct_or_map_field(df, "s", "a")).first()[0] == "x"
    assert df.select(X.struct_or_map_field(df, "s", "zz")).first()[0] is None
    assert df.select(X.struct_or_map_field(df, "nope", "a")).first()[0] is None


def test_json_map_repeated_key_last_wins(spark):
    assert one(spark, '{"a": 1, "a": 2}', lambda c: X.map_field(X.json_map(c), "a")) == "2"


def test_slug_and_parentheses(spark):
    assert one(spark, "https://a/b-pr1/", X.url_slug) == "b-pr1"
    assert one(spark, "(Phường A, HN)", lambda c: X.strip_chars(c, "()")) == "Phường A, HN"


@pytest.mark.parametrize("text,expected", [
    ("a &amp; b", "a & b"), ("les&amp;&amp", "les&&"), ("&amp;lt;", "&lt;"), ("x &lt;y&gt", "x <y>"),
    ("it&#39;s", "it's"), ("&quot;q&quot;", '"q"'),
])
def test_unescape_like_html_parser(spark, text, expected):
    import html
    from homestead.operators.extract import unescape_basic
    assert one(spark, text, unescape_basic) == expected == html.unescape(text)


def test_trim_keeps_nbsp(spark):
    v = " a "
    assert one(spark, v, F.trim) == v


def test_link_rules(spark):
    df = spark.createDataFrame([("/p1",), ("https://other.example/y",), ("https://site.example/z",)], "h string")
    d = "https://site.example"
    got = (df.filter(P.keeps_link("h", d)).select(X.absolute_url("h", d).alias("u"))
             .orderBy("u").collect())
    assert [r.u for r in got] == ["https://site.example/p1", "https://site.example/z"]


def test_page_url_and_cursor(spark):
    df = spark.createDataFrame([("b", 1, 0), ("b", 3, 2), ("b", 4, 5)], "u string, p int, n int")
    # page 1 found nothing -> back to 1; pages 3 and 4 found links -> advance
    got = df.select(X.page_url("u", "p").alias("url"), X.next_page("p", "n").alias("nxt")).collect()
    assert [(r.url, r.nxt) for r in got] == [("b", 1), ("b/p3", 4), ("b/p4", 5)]


def test_range_filter_drops_null(spark):
    df = spark.createDataFrame([(1.0,), (None,), (5.0,)], "x double")
    assert df.filter(P.in_range("x", 0, 10)).count() == 2


def test_class_selected_heading_and_links(spark):
    from homestead.operators import extract as E
    page = ('<h1 class="re__pr-title">Can ho A</h1><h1 class="a re__pr-title b">B</h1><!-- <a href="/no">x</a> -->'
            '<A HREF=/up class=k>u</A><a class="k m" href="/q?a=1&amp;b=2">q</a><a class="km" href=\'/z\'>z</a>'
            '<script>"<a href=/s>"</script>')
    df = spark.createDataFrame([(page,)], "html string")
    got = df.select(E.first_tag_text("html", "h1", "re__pr-title").alias("t"), E.first_tag_text("html", "h1").alias("u"),
                    E.first_tag_text("html", "h1", "pr-title").alias("v"),
                    E.anchor_hrefs("html").alias("all"), E.anchor_hrefs("html", "k").alias("k")).first()
    assert (got.t, got.u, got.v) == ("Can ho A", "Can ho A", "")
    assert got["all"] == ["/up", "/q?a=1&b=2", "/z"] and got.k == ["/up", "/q?a=1&b=2"]
    parsed = E.extract_page(page, E.PageSpec(link=("a", "k")))
    assert parsed["links"] == got.k and parsed["title"] == "Can ho A"
