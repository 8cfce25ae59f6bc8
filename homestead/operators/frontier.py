"""Crawl frontier as tables: the URL work queue, per-location cursor state,
paging URLs and the quarantine of pages that yielded no links.

The source system did these one row at a time through a database cursor; here
each is one set-based DataFrame step over all locations / links at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import text as X
from .keyed import insert_ignore, update_status, upsert

# The source site's domain and its listing locations (display
# name, path below the domain), in the source system's order.
SITE_DOMAIN = "https://batdongsan.com.vn"
LOCATIONS = [
    ("Hà Nội", "/ban-can-ho-chung-cu-ha-noi"),
    ("TP.HCM", "/ban-can-ho-chung-cu-ho-chi-minh"),
    ("Đà Nẵng", "/ban-can-ho-chung-cu-da-nang"),
    ("Bình Dương", "/ban-can-ho-chung-cu-binh-duong"),
    ("Đồng Nai", "/ban-can-ho-chung-cu-dong-nai"),
    ("Hải Phòng", "/ban-can-ho-chung-cu-hai-phong"),
    ("Quảng Ninh", "/ban-can-ho-chung-cu-quang-ninh"),
    ("Khánh Hòa", "/ban-can-ho-chung-cu-khanh-hoa"),
    ("Bà Rịa - Vũng Tàu", "/ban-can-ho-chung-cu-ba-ria-vung-tau"),
    ("Bắc Ninh", "/ban-can-ho-chung-cu-bac-ninh"),
    ("Hưng Yên", "/ban-can-ho-chung-cu-hung-yen"),
]


def locations(spark: SparkSession, domain: str = SITE_DOMAIN) -> DataFrame:
    """The fixed location dimension (11 rows) as a DataFrame."""
    return spark.createDataFrame([(n, domain + p) for n, p in LOCATIONS], S.LOCATION_SCHEMA)


def enqueue(frontier: DataFrame, links: DataFrame, url_col: str = "url") -> DataFrame:
    """Insert unseen links as pending (insert-ignore on url)."""
    return insert_ignore(frontier, links.select(F.col(url_col).alias("url")), ["url"],
                         defaults={"status": F.lit(S.PENDING),
                                   "created_at": F.current_timestamp().cast("timestamp_ntz")})


def queue_take(frontier: DataFrame, n: int, status: str = S.PENDING,
               order_cols=("created_at", "url")) -> DataFrame:
    """The next ``n`` queue entries with ``status``, oldest first (url breaks
    ties, so the take is deterministic). Plans as TakeOrderedAndProject:
    each task keeps only its top n, the driver merges n × tasks rows."""
    return (frontier.filter(F.col("status") == status)
                    .orderBy(*[F.col(c).asc_nulls_last() for c in order_cols])
                    .limit(n))


def mark_crawled(frontier: DataFrame, landed: DataFrame, url_col: str = "url") -> DataFrame:
    """pending -> crawled for urls whose document landed."""
    return update_status(frontier, landed.select(F.col(url_col).alias("url")), "url", "status", S.CRAWLED)


def current_pages(locs: DataFrame, state: DataFrame, name_col: str = "name",
                  default: int = S.FIRST_PAGE) -> DataFrame:
    """Each location with its cursor page (``default`` when it has no state)."""
    st = state.select(F.col("location_name").alias(name_col), "current_page")
    return (locs.join(st, on=name_col, how="left")
                .withColumn("current_page",
                            F.coalesce(F.col("current_page"), F.lit(default)).cast("int")))


def page_urls(locs_with_pages: DataFrame, base_col: str = "url") -> DataFrame:
    """Listing-page URL to fetch for each location."""
    return locs_with_pages.withColumn("page_url", X.page_url(base_col, "current_page"))


def advance_cursor(locs_with_pages: DataFrame, link_counts: DataFrame,
                   name_col: str = "name") -> DataFrame:
    """Next cursor page per location: +1 when the page produced links, else 1.
    ``link_counts(name, n_links)``; a location missing from it found none."""
    lc = link_counts.select(name_col, "n_links")
    return (locs_with_pages.join(lc, on=name_col, how="left")
            .withColumn("n_links", F.coalesce(F.col("n_links"), F.lit(0)).cast("long"))
            .select(F.col(name_col).alias("location_name"),
                    X.next_page("current_page", "n_links").cast("int").alias("current_page"),
                    "n_links"))


def save_cursor(state: DataFrame, advanced: DataFrame) -> DataFrame:
    """Upsert the advanced cursors into the state table (key location_name)."""
    return upsert(state, advanced.select("location_name", "current_page"), ["location_name"], source_unique=True)


def quarantine_by_count(pages: DataFrame, n_links, min_links: int = 1) -> DataFrame:
    """Pages whose own link count (a per-row Column, e.g. ``size`` of the
    page's extracted links) is below ``min_links``: one narrow stage, no join."""
    return (pages.withColumn("n_links", n_links.cast("long"))
                 .filter(F.col("n_links") < min_links))
