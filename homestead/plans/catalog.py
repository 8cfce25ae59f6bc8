"""Registered queries: each is ``f(spark, sf_dir) -> DataFrame`` over the
driver tables (whole tables, no row caps), paired in ``oracle.py`` with an
independent DuckDB statement of the same result."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import predicates as P
from ..functions import text as X
from ..operators import keyed as K
from ..operators import extract as E
from ..operators import frontier as FR
from ..operators import marts as M
from ..operators import quantiles as Q
from ..session import scratch_path, settings
from ..sources.tables import read_table
from .gold import silver_to_gold
from .listings import URL_PREFIX, bronze_documents, crawl_texts, listing_bronze, listing_rows
from .silver import bronze_to_silver

LOAD_STAMP = "2026-01-01 02:00:00"
PRICE_RANGE = (100000.0, 400000.0)
UNIT_RANGE = (2000.0, 60000.0)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _t(spark, sf_dir, name):
    return read_table(spark, sf_dir, name)


def _written(spark, df, name):
    """A derivation that a query reads more than once, written once."""
    path = scratch_path(spark, name)
    df.write.parquet(path, compression="zstd")
    return spark.read.parquet(path)


def _report_listings(spark, sf_dir, city=None):
    """Gold within both report ranges (and one city)."""
    return M.filter_listings(gold_listings(spark, sf_dir), city=city, price_range=PRICE_RANGE, unit_price_range=UNIT_RANGE)


# --- the listings flow ---------------------------------------------------------

def gold_listings(spark, sf_dir) -> DataFrame:
    return silver_to_gold(bronze_to_silver(listing_bronze(spark, sf_dir)), loaded_at=LOAD_STAMP)


@query
def listings_silver(spark, sf_dir):
    """Bronze documents -> silver (all silver rules)."""
    return bronze_to_silver(listing_bronze(spark, sf_dir))


@query
def listings_gold(spark, sf_dir):
    """Silver -> gold: latest crawl per url + derived attributes."""
    return gold_listings(spark, sf_dir)


@query
def report_topk_price(spark, sf_dir):
    """Headline report: top-15 wards by mean price within both report ranges."""
    g = M.filter_listings(gold_listings(spark, sf_dir), price_range=PRICE_RANGE, unit_price_range=UNIT_RANGE)
    return (M.topk_mean(g, "district", "price", alias="mean_price")
            .select("district", F.round("mean_price", 6).alias("mean_price")))


def _frontier(spark, sf_dir, since=None, until=None) -> DataFrame:
    """Queue rows derived from orders: one url per order."""
    o = _t(spark, sf_dir, "orders")
    if since is not None:
        o = o.filter(F.col("o_orderdate") >= F.lit(since).cast("timestamp_ntz"))
    if until is not None:
        o = o.filter(F.col("o_orderdate") < F.lit(until).cast("timestamp_ntz"))
    return o.select(
        F.concat(F.lit(URL_PREFIX), F.col("o_orderkey").cast("string")).alias("url"),
        F.when(F.col("o_orderstatus") == "F", F.lit(S.CRAWLED))
         .otherwise(F.lit(S.PENDING)).alias("status"),
        F.col("o_orderdate").alias("created_at"))


def _lineitem_links(spark, sf_dir) -> DataFrame:
    """One discovered link per lineitem (several per listing)."""
    return _t(spark, sf_dir, "lineitem").select(
        F.concat(F.lit(URL_PREFIX), F.col("l_orderkey").cast("string")).alias("url"))


def _comma2(c):
    return F.replace(F.format_string("%.2f", c), F.lit("."), F.lit(","))


# --- scalar rules (X*) and predicates (F*) ------------------------------------------

@query
def json_field_tolerant(spark, sf_dir):
    """Map field when present, NULL when the key is absent."""
    m = X.json_map("props")
    return _t(spark, sf_dir, "events").select(
        "event_id", X.map_field(m, "k").alias("k"), X.map_field(m, "absent").alias("absent"))


@query
def not_blank_filter(spark, sf_dir):
    """not NULL and not blank."""
    return (_t(spark, sf_dir, "documents").filter(P.not_blank("text"))
            .select("doc_id", "lang", "n_chars"))


@query
def split_address_pair(spark, sf_dir):
    """F2 + X1–X4: keep two-part addresses, split into district / city."""
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    n = _t(spark, sf_dir, "nation")
    r = _t(spark, sf_dir, "region")
    df = (c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
           .select("c_custkey", F.when(F.col("c_acctbal") >= 0,
                                       F.concat("n_name", F.lit(", "), "r_name", F.lit(" mới")))
                                  .otherwise(F.col("n_name")).alias("address_line_2")))
    return (df.filter(P.min_parts("address_line_2", 2))
              .select("c_custkey", X.part("address_line_2", 1).alias("district"),
                      X.strip_city_suffix(X.part("address_line_2", 2)).alias("city")))


STRIP_PREFIX = r"^(small|large|old)\s+"
STRIP_SUFFIX = r"\s+(gear|rod)$"
KEEP_PATTERN = r"^(red|hot|blue|cold|new)\s"


@query
def strip_prefix_suffix(spark, sf_dir):
    """Strip prefix, strip suffix, keep by regex (after stripping)."""
    p = _t(spark, sf_dir, "part")
    name = X.strip_city_suffix(X.strip_district_prefix("p_name", STRIP_PREFIX), STRIP_SUFFIX)
    return (p.select("p_partkey", name.alias("name"))
             .filter(P.matches("name", KEEP_PATTERN)))


@query
def locale_number(spark, sf_dir):
    """Decimal-comma numbers, ranges and words -> double or NULL."""
    o = _t(spark, sf_dir, "orders")
    txt = (F.when(F.col("o_orderstatus") == "F", F.concat(_comma2(F.col("o_totalprice")), F.lit(" tỷ")))
            .when(F.col("o_orderstatus") == "O",
                  F.concat(_comma2(F.col("o_totalprice")), F.lit(" - "),
                           _comma2(F.col("o_totalprice") * 2), F.lit(" tỷ")))
            .otherwise(F.lit("Thỏa thuận")))
    return (o.select("o_orderkey", txt.alias("price_text"))
             .withColumn("price", X.locale_number("price_text")))


@query
def digits_int(spark, sf_dir):
    """Digits-only integer, NULL when there are no digits."""
    return _t(spark, sf_dir, "customer").select(
        "c_custkey", X.digits_int("c_name").alias("name_number"),
        X.digits_int("c_mktsegment").alias("segment_number"))


@query
def parse_date(spark, sf_dir):
    """X9 strict dd/MM/yyyy parse (ISO text -> NULL), X10 timestamp -> date."""
    o = _t(spark, sf_dir, "orders")
    txt = (F.when(F.col("o_orderpriority") == "2-HIGH", F.date_format("o_orderdate", "yyyy-MM-dd"))
            .otherwise(F.date_format("o_orderdate", "dd/MM/yyyy")))
    return o.select("o_orderkey", txt.alias("posted_text"),
                    X.parse_date(txt).alias("posted_date"),
                    X.to_day("o_orderdate").alias("order_day"))


FLAG_KEYWORDS = ("red", "hot", "gear")


@query
def keyword_flag(spark, sf_dir):
    """1 when any keyword is contained (case-insensitive), else 0."""
    return _t(spark, sf_dir, "part").select(
        "p_partkey", X.keyword_flag("p_name", FLAG_KEYWORDS).alias("flag"))


@query
def first_meaningful_part(spark, sf_dir):
    """X14 + K5: first address part that is not a short token / skipped prefix."""
    addr = F.concat_ws(", ", F.col("p_size").cast("string"), "p_type", "p_name", "p_brand")
    return _t(spark, sf_dir, "part").select(
        "p_partkey", addr.alias("address"),
        X.first_meaningful_part(addr, skip_prefix="small").alias("project_name"))


@query
def numeric_coerce(spark, sf_dir):
    """Numeric coercion, bad text -> NULL."""
    return _t(spark, sf_dir, "events").select(
        "event_id", X.to_double(X.json_field("props", "$.k")).alias("k_num"),
        X.to_double("event_type").alias("type_num"))


# --- keyed operators (A1, W5, W8, W9, W13) ------------------------------------------

@query
def latest_per_key(spark, sf_dir):
    """A1: newest event per user (ties broken by the other columns)."""
    ev = _t(spark, sf_dir, "events")
    return K.latest_per_key(ev, ["user_id"], order_by=[F.col("ts").desc_nulls_last()],
                            order_cols=["ts"])


UPSERT_CUTOFF_TARGET = "1999-01-01"
UPSERT_CUTOFF_SOURCE = "1998-01-01"


@query
def upsert(spark, sf_dir):
    """Orders before 1999 upserted with re-priced orders from 1998 on."""
    o = _t(spark, sf_dir, "orders")
    target = o.filter(F.col("o_orderdate") < F.lit(UPSERT_CUTOFF_TARGET).cast("timestamp_ntz"))
    source = (o.filter(F.col("o_orderdate") >= F.lit(UPSERT_CUTOFF_SOURCE).cast("timestamp_ntz"))
               .withColumns({"o_orderstatus": F.lit("U"),
                             "o_totalprice": F.col("o_totalprice") * 2}))
    return K.upsert(target, source, ["o_orderkey"], source_unique=True)


FRONTIER_SPLIT = "2000-01-01"
INSERT_STAMP = "2026-01-01 00:00:00"


@query
def insert_ignore(spark, sf_dir):
    """Add unseen lineitem links to the queue as pending."""
    target = _frontier(spark, sf_dir, until=FRONTIER_SPLIT)
    return K.insert_ignore(target, _lineitem_links(spark, sf_dir), ["url"],
                           defaults={"status": F.lit(S.PENDING),
                                     "created_at": F.lit(INSERT_STAMP).cast("timestamp_ntz")})


@query
def insert_ignore_payload(spark, sf_dir):
    """Unseen lineitem links added with the ship date they bring (of
    several, the first row by the other columns)."""
    target = _frontier(spark, sf_dir, until=FRONTIER_SPLIT)
    new = _t(spark, sf_dir, "lineitem").select(
        F.concat(F.lit(URL_PREFIX), F.col("l_orderkey").cast("string")).alias("url"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("created_at"))
    return K.insert_ignore(target, new, ["url"], defaults={"status": F.lit(S.PENDING)})


@query
def upsert_repeated_source(spark, sf_dir):
    """A source that repeats its keys: the last line of each order
    replaces or adds the order's price."""
    target = (_t(spark, sf_dir, "orders")
              .filter(F.col("o_orderdate") < F.lit(UPSERT_CUTOFF_TARGET).cast("timestamp_ntz"))
              .select("o_orderkey", F.col("o_totalprice").alias("price")))
    source = _t(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_extendedprice").alias("price"), "l_linenumber")
    return K.upsert(target, source, ["o_orderkey"], source_order=[F.col("l_linenumber").desc()])


@query
def insert_ignore_count(spark, sf_dir):
    """How many links an insert-ignore adds; a Bloom filter of the links
    keeps most of the frontier out of the shuffle."""
    target = _frontier(spark, sf_dir, until=FRONTIER_SPLIT)
    return K.new_rows(target, _lineitem_links(spark, sf_dir), ["url"], prefilter=True).agg(
        F.count(F.lit(1)).alias("n_new"))


@query
def update_status(spark, sf_dir):
    """Pending -> crawled for links whose page landed."""
    landed = (_t(spark, sf_dir, "lineitem").filter(F.col("l_linestatus") == "F")
              .select(F.concat(F.lit(URL_PREFIX), F.col("l_orderkey").cast("string")).alias("url")))
    return K.update_status(_frontier(spark, sf_dir), landed)


@query
def key_violations(spark, sf_dir):
    """Slugs that are not unique across pages."""
    pages = _t(spark, sf_dir, "pages").select(X.url_slug("url").alias("slug"))
    return K.key_violations(pages, ["slug"])


@query
def url_slug(spark, sf_dir):
    """Last path segment of the url."""
    return _t(spark, sf_dir, "pages").select("page_id", X.url_slug("url").alias("slug"))


# --- frontier (S6, S7, W10, X21, X23, W14) ---------------------------------------------

@query
def queue_take(spark, sf_dir):
    """Next 10 pending urls, oldest first."""
    return FR.queue_take(_frontier(spark, sf_dir), 10)


def _places(spark, sf_dir) -> DataFrame:
    """Locations: the nations, and the regions, which have no customers of
    their own and so neither a saved cursor nor links at any scale."""
    place = lambda t, c: _t(spark, sf_dir, t).select(
        F.col(c).alias("name"), F.concat(F.lit("https://nha.example/ban-"), F.lower(c)).alias("url"))
    regions = place("region", "r_name").withColumns({"name": F.concat(F.lit("Region "), "name"),
                                                     "url": F.concat("url", F.lit("-region"))})
    return place("nation", "n_name").unionByName(regions)


def _place_state(spark, sf_dir) -> DataFrame:
    """Saved cursors: the number of customers in debt per nation."""
    c = _t(spark, sf_dir, "customer").select("c_nationkey", "c_acctbal")
    n = _t(spark, sf_dir, "nation")
    per = c.groupBy("c_nationkey").agg(F.sum((F.col("c_acctbal") < 0).cast("int")).cast("int").alias("current_page"))
    return per.join(n, per.c_nationkey == n.n_nationkey).select(F.col("n_name").alias("location_name"), "current_page")


def _place_links(spark, sf_dir) -> DataFrame:
    """Links found per nation: its customers' urgent orders."""
    o = _t(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority")
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = _t(spark, sf_dir, "nation")
    per = (o.join(c, o.o_custkey == c.c_custkey).groupBy("c_nationkey")
            .agg(F.sum((F.col("o_orderpriority") == "1-URGENT").cast("int")).alias("n_links")))
    return per.join(n, per.c_nationkey == n.n_nationkey).select(F.col("n_name").alias("name"), "n_links")


@query
def state_lookup_default(spark, sf_dir):
    """S7/J4 + X21: cursor page per location (default 1) and its page url."""
    pages = FR.current_pages(_places(spark, sf_dir), _place_state(spark, sf_dir))
    return FR.page_urls(pages).select("name", "current_page", "page_url")


@query
def cursor_advance(spark, sf_dir):
    """Next page per location from the links its page produced; a
    location without links starts again at 1."""
    pages = FR.current_pages(_places(spark, sf_dir), _place_state(spark, sf_dir))
    return FR.advance_cursor(pages, _place_links(spark, sf_dir))


@query
def cursor_saved(spark, sf_dir):
    """The advanced cursors upserted into the saved state."""
    state = _place_state(spark, sf_dir)
    advanced = FR.advance_cursor(FR.current_pages(_places(spark, sf_dir), state), _place_links(spark, sf_dir))
    return FR.save_cursor(state, advanced)


MIN_LINKS = 6


@query
def quarantine_few_links(spark, sf_dir):
    """Pages with fewer than MIN_LINKS links go to quarantine."""
    pages = _t(spark, sf_dir, "pages")
    return FR.quarantine_by_count(pages.select("page_id", "url", "html"),
                                  F.size(E.anchor_hrefs("html")), MIN_LINKS).drop("html")


# --- extraction (H1–H7) -----------------------------------------------------------------

@query
def extract_links(spark, sf_dir):
    """Page links, foreign ones dropped, relative made absolute."""
    return E.extract_links(_t(spark, sf_dir, "pages"))


@query
def extract_heading(spark, sf_dir):
    """H2/H6: text of the first <h1>; pages without one are rejected."""
    pages = _t(spark, sf_dir, "pages").filter(F.col("html").rlike("<h1[\\s>]"))
    return pages.select("page_id", E.first_tag_text("html", "h1").alias("title"))


DRIVER_PAGE_SPEC = E.PageSpec(title=("h1", None), description=("div", "ad"), link=("a", None))


@query
def extract_document(spark, sf_dir):
    """H2–H7: full document through the HTML parser (maps as JSON text)."""
    docs = E.extract_documents(_t(spark, sf_dir, "pages"), DRIVER_PAGE_SPEC)
    return docs.select("page_id", "title", "description",
                       F.to_json("short_info").alias("short_info"),
                       F.size("links").alias("n_links"))


# --- report marts over the gold fact (A3–A15, K1–K2, P6–P7) -----------------------------

REPORT_CITY = "ASIA"
BEDROOMS = (1, 2, 3)


@query
def header_kpi(spark, sf_dir):
    """A3/A4: row count and freshness."""
    return M.header_kpis(_t(spark, sf_dir, "events"), "ts")


@query
def filter_bounds(spark, sf_dir):
    """Price and unit-price bounds within one city."""
    g = M.filter_listings(gold_listings(spark, sf_dir), city=REPORT_CITY)
    return M.bounds(g, ["price", "price_per_m2"])


@query
def distinct_sorted(spark, sf_dir):
    """Sorted distinct cities."""
    return M.distinct_sorted(gold_listings(spark, sf_dir), "city")


@query
def distinct_bedrooms(spark, sf_dir):
    """A10: sorted distinct bedroom counts within the chosen city."""
    g = M.filter_listings(gold_listings(spark, sf_dir), city=REPORT_CITY)
    return M.distinct_sorted(g, "num_bedrooms")


@query
def filtered_kpis(spark, sf_dir):
    """KPIs of the filtered listings."""
    g = M.filter_listings(gold_listings(spark, sf_dir), city=S.ALL_SENTINEL,
                          price_range=PRICE_RANGE, unit_price_range=UNIT_RANGE,
                          bedrooms=BEDROOMS)
    return M.listing_kpis(g)


@query
def topk_mean(spark, sf_dir):
    """Top-15 nations by mean customer balance."""
    c = _t(spark, sf_dir, "customer")
    n = _t(spark, sf_dir, "nation")
    df = c.join(n, c.c_nationkey == n.n_nationkey)
    return (M.topk_mean(df, "n_name", "c_acctbal")
            .select("n_name", F.round("mean_value", 6).alias("mean_value")))


@query
def topk_mean_unit(spark, sf_dir):
    """Top-15 brands by mean unit price (extended price / quantity)."""
    li = _t(spark, sf_dir, "lineitem").select(
        "l_partkey", (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"))
    p = _t(spark, sf_dir, "part").select("p_partkey", "p_brand")
    df = li.join(p, li.l_partkey == p.p_partkey)
    return (M.topk_mean(df, "p_brand", "unit_price")
            .select("p_brand", F.round("mean_value", 6).alias("mean_value")))


@query
def topk_mean_unit_listings(spark, sf_dir):
    """A12/K2 on the gold fact: top-15 wards by mean unit price."""
    g = _report_listings(spark, sf_dir)
    return (M.topk_mean(g, "district", "price_per_m2", alias="mean_unit_price")
            .select("district", F.round("mean_unit_price", 6).alias("mean_unit_price")))


@query
def share_two_way(spark, sf_dir):
    """Purchases vs all other events."""
    ev = _t(spark, sf_dir, "events").select(
        (F.col("event_type") == "purchase").cast("int").alias("is_purchase"))
    return M.share_two_way(ev, "is_purchase", ("purchase", "other"))


@query
def share_legal_docs(spark, sf_dir):
    """A13 on the gold fact: listings with vs without legal documents."""
    return M.share_two_way(_report_listings(spark, sf_dir), "has_legal_docs",
                           ("with_docs", "unknown"))


def _box(df, group, value, method):
    out = Q.box_stats(df, group, value, method=method)
    return out.select(group, "n", *[F.round(c, 6).alias(c) for c in
                                    ("q1", "median", "q3", "lower_whisker", "upper_whisker")],
                      "n_outliers")


@query
def box_stats(spark, sf_dir):
    """Quartiles (type 7), whiskers, outliers of value per event type."""
    return _box(_t(spark, sf_dir, "events"), "event_type", "value", "linear")


@query
def box_stats_midpoint(spark, sf_dir):
    """A14 variant: quartiles interpolated at n·p + 0.5 (type 5)."""
    return _box(_t(spark, sf_dir, "events"), "event_type", "value", "midpoint")


@query
def box_stats_listings(spark, sf_dir):
    """A14 on the gold fact: price distribution per city (written once, the
    operator reads it three times)."""
    sold = _written(spark, _report_listings(spark, sf_dir).select("city", "price"), "box-listings")
    return _box(sold, "city", "price", "linear")


def _hist(df, value):
    h = M.histogram(df, value, S.HISTOGRAM_BINS)
    return h.select("bin", F.round("bin_lo", 6).alias("bin_lo"),
                    F.round("bin_hi", 6).alias("bin_hi"), "n_rows")


@query
def histogram_20(spark, sf_dir):
    """20 equal-width bins of event value."""
    return _hist(_t(spark, sf_dir, "events"), "value")


@query
def histogram_listings(spark, sf_dir):
    """A15 on the gold fact: price histogram within one city."""
    return _hist(_written(spark, _report_listings(spark, sf_dir, REPORT_CITY).select("price"), "histogram-price"), "price")


@query
def scatter_projection(spark, sf_dir):
    """area/price/city + hover columns of the filtered listings."""
    g = M.filter_listings(gold_listings(spark, sf_dir), price_range=PRICE_RANGE,
                          unit_price_range=UNIT_RANGE)
    return M.scatter_projection(g)


@query
def lookup_projection(spark, sf_dir):
    """The lookup table of the filtered listings."""
    g = M.filter_listings(gold_listings(spark, sf_dir), price_range=PRICE_RANGE,
                          unit_price_range=UNIT_RANGE, bedrooms=BEDROOMS)
    return M.lookup_projection(g)


# --- storage round trips (W3/S3, W5 on gold, T1) -----------------------------------------

@query
def partition_roundtrip(spark, sf_dir):
    """W3 + S3: events written dt-partitioned, read back with partition pruning."""
    from ..sources.tables import read_partitioned, write_partitioned
    path = scratch_path(spark, "events-by-day")
    ev = _t(spark, sf_dir, "events").withColumn("dt", X.to_day("ts"))
    write_partitioned(ev, path)
    return (read_partitioned(spark, path, since="2024-01-10", until="2024-01-20")
            .select("event_id", "user_id", "event_type", "value", "dt"))


@query
def partition_roundtrip_all(spark, sf_dir):
    """W3 + S3: the same table read back without bounds."""
    from ..sources.tables import read_partitioned, write_partitioned
    path = scratch_path(spark, "events-by-day-all")
    write_partitioned(_t(spark, sf_dir, "events").withColumn("dt", X.to_day("ts")), path)
    return read_partitioned(spark, path).select("event_id", "user_id", "event_type", "value", "dt")


GOLD_SPLIT = "1997-01-01"


@query
def gold_upsert_incremental(spark, sf_dir):
    """W5 on gold: gold of early crawls upserted with gold of later crawls
    equals gold of all crawls."""
    silver = _written(spark, bronze_to_silver(listing_bronze(spark, sf_dir)), "silver")
    cut = F.lit(GOLD_SPLIT).cast("timestamp_ntz")
    early = silver_to_gold(silver.filter(F.col("crawled_at") < cut), loaded_at=LOAD_STAMP)
    late = silver_to_gold(silver.filter(F.col("crawled_at") >= cut), loaded_at=LOAD_STAMP)
    return K.upsert(early, _written(spark, late, "gold-late"), [S.GOLD_KEY], source_unique=True)


# --- the production path (S1, W1, L1–L7, A2) ---------------------------------------------

#: Landing makes wide documents of narrow rows, in files of one task each: its tasks take less of them.
NARROW = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m", "spark.sql.files.maxPartitionBytes": "32m"}


def _documents(rows, keep=()) -> DataFrame:
    """Bronze documents of ``listing_rows``, with the columns named in ``keep``."""
    return bronze_documents(crawl_texts(rows, keep), keep)


def _rows_written(spark, sf_dir, name) -> DataFrame:
    """The listings' source rows, written once for several landings: narrower than documents."""
    with settings(spark, NARROW):
        return _written(spark, listing_rows(spark, sf_dir), f"{name}-rows")


def _land(spark, docs, bronze_root, day) -> None:
    """One landing, in compressed files."""
    from ..sources.bronze import land_bronze
    with settings(spark, NARROW):
        land_bronze(docs, bronze_root, day=day, compression="gzip", clustered=True)


def _landed(spark, sf_dir, name) -> str:
    """Root of a run, with all crawls landed by month under ``bronze``: the rows
    are clustered by month while they are narrow, and then made documents."""
    from ..sources.bronze import land_bronze
    root = scratch_path(spark, name)
    rows = listing_rows(spark, sf_dir).withColumn("_month", F.trunc("l_shipdate", "month")).hint("rebalance", "_month")
    with settings(spark, NARROW):
        land_bronze(_documents(rows), f"{root}/bronze", granularity="month", compression="gzip", clustered=True)
    return root


@query
def etl_gold(spark, sf_dir):
    """L1: landed bronze -> silver -> published gold."""
    from ..sources.tables import read_versioned
    from .etl import run_etl
    root = _landed(spark, sf_dir, "etl")
    run_etl(spark, f"{root}/bronze", f"{root}/silver", f"{root}/gold", loaded_at=LOAD_STAMP)
    return read_versioned(spark, f"{root}/gold").select(*S.GOLD_COLUMNS)


LANDINGS = ("2026-01-01", "2026-01-02")


def _sold_late(rows) -> tuple[DataFrame, DataFrame]:
    """Documents of the lots not yet sold, and of those sold."""
    late = F.coalesce(F.col("l_returnflag") == "A", F.lit(False))
    return _documents(rows.filter(~late)), _documents(rows.filter(late))


def _two_landings(spark, sf_dir) -> str:
    """A full run over the first landing, then an incremental one over the
    second: sold lots land late, so the crawl dates of both overlap."""
    from .etl import run_etl
    root = scratch_path(spark, "etl-incremental")
    first, second = _sold_late(_rows_written(spark, sf_dir, "etl-incremental"))
    args = (f"{root}/bronze", f"{root}/silver", f"{root}/gold")
    _land(spark, first, f"{root}/bronze", LANDINGS[0])
    run_etl(spark, *args, loaded_at=LOAD_STAMP)
    _land(spark, second, f"{root}/bronze", LANDINGS[1])
    run_etl(spark, *args, loaded_at=LOAD_STAMP, incremental=True, since=LANDINGS[1])
    return root


@query
def etl_incremental(spark, sf_dir):
    """L1: silver after a full and an incremental run with overlapping crawl
    dates equals a full rebuild."""
    from ..sources.tables import read_partitioned
    return read_partitioned(spark, f"{_two_landings(spark, sf_dir)}/silver").select(*S.SILVER_COLUMNS)


@query
def etl_incremental_gold(spark, sf_dir):
    """L1: and so does gold, although older crawls land later."""
    from ..sources.tables import read_versioned
    return read_versioned(spark, f"{_two_landings(spark, sf_dir)}/gold").select(*S.GOLD_COLUMNS)


# --- marts maintained from gold's changed buckets (A5, A6, A11-A13) -----------------------

def _maintained(spark, sf_dir) -> str:
    """The view after both landings, refreshed behind each of them."""
    from . import mart_views as V
    from .etl import run_etl
    root = scratch_path(spark, "marts")
    for i, (day, some) in enumerate(zip(LANDINGS, _sold_late(_rows_written(spark, sf_dir, "marts")))):
        _land(spark, some, f"{root}/bronze", day)
        run_etl(spark, f"{root}/bronze", f"{root}/silver", f"{root}/gold", loaded_at=LOAD_STAMP,
                incremental=i > 0, since=day if i else None)
        V.refresh(spark, f"{root}/gold", f"{root}/view")
    return f"{root}/view"


@query
def marts_maintained(spark, sf_dir):
    """KPIs of every city, district and bedroom number."""
    from . import mart_views as V
    view = V.read_view(spark, _maintained(spark, sf_dir))
    return view.select(*V.GRAIN, F.col("n").alias("n_listings"), "n_flagged",
                       *[F.round(F.try_divide(F.col(f"sum_{v}").cast("double"), F.col(f"n_{v}")), 6).alias(f"mean_{v}")
                         for v in V.VALUES.values()])


@query
def marts_maintained_topk(spark, sf_dir):
    """The districts of the highest mean price."""
    from . import mart_views as V
    top = V.topk_mean(V.read_view(spark, _maintained(spark, sf_dir)), "district", "price", alias="mean_price")
    return top.select("district", F.round("mean_price", 6).alias("mean_price"))


def _late_landings(spark, sf_dir) -> str:
    """Four runs: new crawls, older ones, the same landing corrected (it held
    crawls too many), then undated and late ones. Third lines are undated, the
    others are dated to the first of their month."""
    from .etl import run_etl
    root = scratch_path(spark, "etl-late")
    rows, line = _rows_written(spark, sf_dir, "etl-late"), F.col("l_linenumber")
    month = F.concat(F.substring("crawled_at", 1, 7), F.lit("-01"), F.expr("substring(crawled_at, 11)"))
    args = (f"{root}/bronze", f"{root}/silver", f"{root}/gold")

    def landed(day, first, last):
        some = _documents(rows.filter(line.between(first, last)), keep=("l_linenumber",))
        some = some.withColumn("crawled_at", F.when(line == 3, F.lit(None).cast("string")).otherwise(month)).drop("l_linenumber")
        with settings(spark, NARROW):
            some.write.mode("overwrite").json(f"{root}/bronze/dt={day}", compression="gzip")
        run_etl(spark, *args, loaded_at=LOAD_STAMP, incremental=day != "2026-01-01", since=None if day == "2026-01-01" else day)
    landed("2026-01-01", 5, 99)
    landed("2026-01-02", 1, 4)
    landed("2026-01-02", 1, 2)
    landed("2026-01-03", 3, 4)
    return root


@query
def etl_rerun(spark, sf_dir):
    """Silver after a landing was corrected to fewer documents, and
    after late and undated ones, equals a full rebuild."""
    from ..sources.tables import read_partitioned
    return read_partitioned(spark, f"{_late_landings(spark, sf_dir)}/silver").select(*S.SILVER_COLUMNS)


@query
def etl_late_gold(spark, sf_dir):
    """And so does gold, merged by recency: no run reads old silver."""
    from .etl import read_gold
    return read_gold(spark, f"{_late_landings(spark, sf_dir)}/gold")


#: Documents of one file of ``_landed_by_line``: many enough that a stream reads it with all cores.
FILE_DOCS = 1_000_000


def _landed_by_line(spark, sf_dir, name, step) -> str:
    """Root with the crawls landed in order from the last lines to the first,
    ``step`` line numbers a landing: crawl dates come out of order. Files are
    few and large, as each is a micro-batch, and compressed: the documents as
    text are more than all that the stream writes of them."""
    from ..sources.bronze import land_bronze
    root = scratch_path(spark, name)
    rows = _rows_written(spark, sf_dir, name)
    for i, last in enumerate(range(7, 0, -step)):
        some = rows.filter(F.col("l_linenumber").between(last - step + 1, last if i else 99))
        docs = _documents(some).coalesce(-(-some.count() // FILE_DOCS) or 1)
        land_bronze(docs, f"{root}/bronze", day=f"2026-01-{i + 1:02d}", compression="lz4", clustered=True)
    return root


@query
def stream_ingest(spark, sf_dir):
    """Bronze JSON, ingested by an availableNow stream into silver
    Parquet; the result equals the batch silver transform."""
    from ..streaming.ingest import ingest_bronze_stream
    root = _landed(spark, sf_dir, "stream")
    ingest_bronze_stream(spark, f"{root}/bronze", f"{root}/silver", f"{root}/_checkpoint")
    return spark.read.parquet(f"{root}/silver").select(*S.SILVER_COLUMNS)


@query
def stream_dedupe(spark, sf_dir):
    """A stream that writes each url's first arrival, one file a
    micro-batch, from Spark's keyed state; a restart adds nothing."""
    from ..streaming.ingest import first_per_key_stream
    root = _landed_by_line(spark, sf_dir, "stream-dedupe", 2)
    for _ in range(2):
        first_per_key_stream(spark, f"{root}/bronze", f"{root}/silver", f"{root}/_checkpoint", max_files_per_trigger=1)
    return spark.read.parquet(f"{root}/silver").select(*S.SILVER_COLUMNS)


@query
def stream_gold(spark, sf_dir):
    """A stream from bronze over silver to gold, one file a micro-batch,
    each upserted once by recency; the last batch is replayed."""
    from ..streaming.ingest import stream_to_gold, upsert_batch
    from .etl import read_gold
    root = _landed_by_line(spark, sf_dir, "stream-gold", 3)
    stream_to_gold(spark, f"{root}/bronze", f"{root}/silver", f"{root}/gold", f"{root}/_checkpoint",
                   max_files_per_trigger=1, loaded_at=LOAD_STAMP)
    silver = spark.read.parquet(f"{root}/silver")
    last = silver.agg(F.max("batch")).first()[0]
    if last is not None:
        upsert_batch(silver.filter(F.col("batch") == last), last, f"{root}/gold", loaded_at=LOAD_STAMP)
    return read_gold(spark, f"{root}/gold")


# --- the queue as a log with leases (S6, W9, L6) ------------------------------------------

def _queue_log(spark, sf_dir) -> str:
    """The orders' urls enqueued, those of finished orders landed."""
    from ..operators import queue_log as QL
    root = scratch_path(spark, "queue-log")
    urls = _frontier(spark, sf_dir)
    QL.enqueue(urls, root)
    QL.land(urls.filter(F.col("status") == S.CRAWLED), root)
    return root


@query
def queue_log_state(spark, sf_dir):
    """Landings are appended, the log is compacted in between; the
    state is the queue with their urls crawled."""
    from ..operators import queue_log as QL
    root = _queue_log(spark, sf_dir)
    QL.compact(spark, root)
    QL.land(_t(spark, sf_dir, "lineitem").filter(F.col("l_linestatus") == "F")
            .select(F.concat(F.lit(URL_PREFIX), F.col("l_orderkey").cast("string")).alias("url")), root)
    return QL.state(spark, root).select("url", "status", "created_at")


@query
def queue_take_leased(spark, sf_dir):
    """Two takes share no live lease; half of the first take's urls land,
    and when the leases have run out the rest are taken again."""
    import datetime as dt
    from ..operators import queue_log as QL
    root, start, hour = _queue_log(spark, sf_dir), dt.datetime(2026, 1, 1), dt.timedelta(hours=1)
    first = QL.take(spark, root, 10, "a", start, hour)
    second = QL.take(spark, root, 10, "b", start + hour / 2, hour)
    QL.land(first.orderBy("created_at", "url").limit(5), root)
    third = QL.take(spark, root, 10, "c", start + 2 * hour, hour)
    return first.unionByName(second).unionByName(third)


# --- extraction from listing markup (H1–H7) and the crawl rounds --------------------------

LISTING_SITE = "https://nha.example"


PAGES_A_TASK = 25_000


def _orders_with_customer(spark, sf_dir) -> DataFrame:
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    n = _t(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    joined = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    # parsing is the work: spread it evenly, before html is built, in tasks that grow in number and not in size
    tasks = max(spark.sparkContext.defaultParallelism, o.count() // PAGES_A_TASK)
    return joined.repartition(tasks, "o_orderkey")


def listing_pages(spark, sf_dir) -> DataFrame:
    """One listing page per order: no title element on some, references and
    comments, tags in capitals, values without quotes, text in two pieces."""
    spec = E.PageSpec()
    key = F.col("o_orderkey").cast("string")
    open_ = lambda sel, close=">": F.lit(f'<{sel[0]} class="x {sel[1]}"{close}')

    def element(sel, *inner):
        return F.concat(open_(sel), *inner, F.lit(f"</{sel[0]}>"))

    def link(href):
        return F.concat(open_(spec.link, " href="), href, F.lit(">l</a>"))
    price = F.concat(F.format_string("%.2f", "o_totalprice"), F.lit(" &lt;tỷ&gt;"))
    html = F.concat(
        F.lit("<!DOCTYPE html><html><body><!-- "), link(F.concat(F.lit('"/hidden-'), key, F.lit('"'))), F.lit(" -->"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("<p>try again later</p>"))
         .otherwise(element(spec.title, F.lit(" Căn hộ "), "c_mktsegment", F.lit(" &amp; "), key, F.lit(" "))),
        element(spec.address_1, F.lit("Số "), key, F.lit(", "), "n_name"),
        element(spec.address_2, F.lit("(Phường "), "n_name", F.lit(", B mới)")),
        element(spec.short_item, element(spec.short_label, F.lit("Khoảng giá")), element(spec.short_value, price),
                F.when(F.col("o_orderstatus") == "F", element(spec.short_ext, F.lit("~"), key, F.lit(" triệu/m²")))
                 .otherwise(F.lit(""))),
        element(spec.short_item, element(spec.short_label, F.lit("Không có giá trị"))),
        element(spec.spec_item, element(spec.spec_label, F.lit("Pháp lý")), element(spec.spec_value, "c_mktsegment")),
        element(spec.description, F.lit("Mô tả "), key, F.lit("<br><script>var t='<b>';</script> dòng hai ")),
        link(F.concat(F.lit('"/p'), key, F.lit('?a=1&amp;b=2"'))),
        F.lit("<A HREF=/up"), key, F.lit(f" CLASS={spec.link[1]}>L</A>"),
        link(F.concat(F.lit("'https://other.example/"), key, F.lit("'"))),
        F.lit('<a href="/menu">m</a></body></html>'))
    return _orders_with_customer(spark, sf_dir).select(
        F.col("o_orderkey").alias("page_id"), F.concat(F.lit(URL_PREFIX), key).alias("url"), html.alias("html"))


@query
def extract_listing_document(spark, sf_dir):
    """H2–H5, H7: the bronze document of every listing page with a title."""
    extracted = E.extract_documents(listing_pages(spark, sf_dir))
    return E.bronze_from_pages(extracted, crawled_at="2026-01-01 00:00:00").select(
        "url", "title", "address", "address_line_2", "description", "crawled_at",
        F.element_at("short_info", "Khoảng giá").alias("price"),
        F.try_element_at("short_info", F.lit("Khoảng giá(ext)")).alias("price_ext"), F.size("short_info").alias("n_short"),
        F.element_at("specs", "Pháp lý").alias("legal"), F.size("specs").alias("n_specs"))


@query
def rejected_pages(spark, sf_dir):
    """H6: the listing pages without the title element."""
    extracted = E.extract_documents(listing_pages(spark, sf_dir), fields=("has_title",))
    return E.rejected_pages(extracted).select("page_id", "url")


@query
def extract_listing_links(spark, sf_dir):
    """Class-selected links, built-ins only."""
    return E.extract_links(listing_pages(spark, sf_dir), domain=LISTING_SITE, cls=E.PageSpec().link[1])


@query
def extract_listing_links_parsed(spark, sf_dir):
    """H1: the same links as the parser finds them (foreign ones included)."""
    docs = E.extract_documents(listing_pages(spark, sf_dir), fields=("links",))
    return docs.select("page_id", F.posexplode("links").alias("pos", "href"))


def _customer_round(spark, sf_dir):
    """A link round: every customer is a location (in debt: cursor at page 2),
    whose page links its urgent open orders; many customers have none."""
    from .crawl import link_round
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    name = F.concat(F.lit("loc-"), F.col("c_custkey").cast("string"))
    locs = c.select(name.alias("name"), F.concat(F.lit(f"{LISTING_SITE}/"), name).alias("url"))
    state = c.filter("c_acctbal < 0").select(name.alias("location_name"), F.lit(2).alias("current_page"))
    listed = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT")
    anchors = (_t(spark, sf_dir, "orders").filter(listed).groupBy("o_custkey").agg(F.concat_ws("", F.sort_array(F.collect_list(
        F.concat(F.lit('<a href="/can-ho-'), F.col("o_orderkey").cast("string"), F.lit('">o</a>'))))).alias("a")))
    pages = c.join(anchors, c.c_custkey == F.col("o_custkey"), "left").select(
        F.col("c_custkey").alias("page_id"),
        F.concat(F.lit(f"{LISTING_SITE}/"), name, F.when(F.col("c_acctbal") < 0, F.lit("/p2")).otherwise(F.lit(""))).alias("url"),
        F.concat(F.lit("<body>"), F.coalesce("a", F.lit("none")), F.lit("</body>")).alias("html"))
    return link_round(locs, state, _frontier(spark, sf_dir, until=FRONTIER_SPLIT), pages, LISTING_SITE)


@query
def link_round_frontier(spark, sf_dir):
    """Entry D, links: the queue after the round."""
    return _customer_round(spark, sf_dir).frontier.select("url", "status")


@query
def link_round_state(spark, sf_dir):
    """Entry D, links: the cursors after the round."""
    return _customer_round(spark, sf_dir).state


@query
def link_round_quarantine(spark, sf_dir):
    """Entry D, links: pages without links."""
    return _customer_round(spark, sf_dir).quarantine


DETAIL_TAKE = 1000


@query
def detail_round(spark, sf_dir):
    """Entry D, details: the queue after the oldest pending urls' pages were
    extracted and landed; pages without a title stay pending."""
    from .crawl import run_detail_round
    root = scratch_path(spark, "detail-bronze")
    return run_detail_round(_frontier(spark, sf_dir), listing_pages(spark, sf_dir), DETAIL_TAKE, f"{root}/bronze",
                            crawled_at="2026-01-01 00:00:00").frontier
