"""Set-based crawl rounds over stored pages (the ingestion loop as Spark jobs).

``link_round``: listing pages of every location -> their links -> insert the
unseen ones into the queue as pending -> advance every location's cursor
(+1 when its page had links, else back to 1) -> pages without links go to
quarantine. ``run_detail_round``: take the next pending urls, extract the
documents of their fetched pages once, land the valid ones (title present),
and mark crawled what the landed files hold. Fetching the pages is outside
Spark; both rounds take the fetched ``pages`` as input.

No side is broadcast by hand: the location list and the queue take are usually
small, and then Spark's own size rules broadcast them.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import extract as E
from ..operators import frontier as FR
from ..session import scratch_path
from ..sources.bronze import land_bronze, read_bronze


@dataclass
class LinkRound:
    frontier: DataFrame      # queue after insert-ignore
    state: DataFrame         # cursor state after the upsert
    quarantine: DataFrame    # location pages that yielded no links
    page_urls: DataFrame     # what to fetch next round (location, page_url)


def link_round(locs: DataFrame, state: DataFrame, frontier: DataFrame, pages: DataFrame,
               domain: str, link_class: str | None = None) -> LinkRound:
    """``pages(page_id, url, html)`` are the fetched listing pages; a page
    belongs to the location whose current ``page_url`` it was fetched from."""
    current = FR.page_urls(FR.current_pages(locs, state))
    fetched = (pages.join(current.select("name", F.col("page_url").alias("url")), on="url")
                    .select("page_id", "url", "name", E.page_links(F.lit(domain), link_class).alias("links")))
    counts = fetched.groupBy("name").agg(F.sum(F.size("links")).cast("long").alias("n_links"))
    advanced = FR.advance_cursor(current, counts)
    new_state = FR.save_cursor(state, advanced)
    new_frontier = FR.enqueue(frontier, fetched.select(F.explode("links").alias("url")))
    quarantined = FR.quarantine_by_count(fetched, F.size("links")).drop("links")
    next_urls = FR.page_urls(FR.current_pages(locs, new_state)).select("name", "page_url")
    return LinkRound(new_frontier, new_state, quarantined, next_urls)


@dataclass
class DetailRound:
    bronze: DataFrame        # valid documents, as landed
    rejected: DataFrame      # pages without the title element (not stored)
    frontier: DataFrame      # queue with the landed urls marked crawled


def run_detail_round(frontier: DataFrame, pages: DataFrame, n: int, bronze_root: str,
                     spec: E.PageSpec = E.PageSpec(), crawled_at=None) -> DetailRound:
    """Process the next ``n`` pending urls whose pages were fetched: extract
    them once into a work table, land the valid documents under the crawl day,
    and only then mark crawled the urls found in the landed files."""
    spark = frontier.sparkSession
    stamp = str(crawled_at or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None))
    take = FR.queue_take(frontier, n).select("url")
    path = scratch_path(spark, "detail-round")
    E.extract_documents(pages.join(take, on="url", how="left_semi"), spec).write.parquet(path)
    extracted = spark.read.parquet(path)
    land_bronze(E.bronze_from_pages(extracted, crawled_at=stamp), bronze_root, day=stamp[:10])
    landed = (read_bronze(spark, bronze_root).filter(F.col("dt") == F.lit(stamp[:10]).cast("date"))
              .join(extracted.select("url").distinct(), "url", "left_semi"))
    return DetailRound(landed, E.rejected_pages(extracted), FR.mark_crawled(frontier, landed))
