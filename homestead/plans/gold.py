"""Silver -> gold: dedupe by url (one shuffle), derive the three listing
attributes, fixed final projection."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import text as X
from ..operators.keyed import any_per_key, latest_per_key


#: The silver columns that gold is made of, in silver's order.
GOLD_INPUT = [c for c in S.SILVER_COLUMNS if c not in (
    "address_line_2", "description", "price_raw", "price_per_m2_raw", "area_raw", "bedrooms_raw",
    "posted_date_str", "expired_date_str")]


def dedupe_listings(silver: DataFrame, latest: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per url, with the columns gold is made of. ``latest=True``:
    newest ``crawled_at`` wins, ties broken by those columns (rows equal there
    give equal gold rows); else an arbitrary row. Only these columns are read,
    sorted and shuffled: the scan never touches descriptions or raw texts."""
    silver = silver.select(*GOLD_INPUT, *[c for c in keep if c not in GOLD_INPUT])
    if not latest:
        return any_per_key(silver, [S.GOLD_KEY])
    return latest_per_key(silver, [S.GOLD_KEY],
                          order_by=[F.col("crawled_at").desc_nulls_last()],
                          order_cols=["crawled_at"])


def load_stamp(loaded_at=None) -> Column:
    """Load time as a zone-less timestamp: ``current_timestamp()`` (wall clock
    of the session time zone, pinned to UTC) in production; fixed in tests."""
    if loaded_at is None:
        return F.current_timestamp().cast("timestamp_ntz")
    if isinstance(loaded_at, Column):
        return loaded_at.cast("timestamp_ntz")
    if isinstance(loaded_at, str):
        return F.lit(loaded_at).cast("timestamp_ntz")
    if isinstance(loaded_at, _dt.datetime):
        return F.lit(loaded_at).cast("timestamp_ntz")
    raise TypeError(f"unsupported loaded_at: {loaded_at!r}")


def enrich(df: DataFrame) -> DataFrame:
    """has_legal_docs, num_bedrooms, project_name."""
    return df.withColumns({
        "has_legal_docs": X.keyword_flag("legal_status"),
        "num_bedrooms": X.digits_int("specs_bedrooms_raw"),
        "project_name": X.first_meaningful_part("address"),
    })


#: The columns that decide between crawls of one moment, in order.
TIE = [c for c in GOLD_INPUT if c not in (S.GOLD_KEY, "crawled_at")]
#: Side columns of the stored gold and the inputs they hold: the day the row's
#: crawl landed, and the inputs that are no gold columns. With these a stored row
#: is what it was made of again, so crawls are compared, shuffled and merged as
#: inputs and become gold rows when they are written.
SIDE = {"_crawled_at": "crawled_at", "_load": "load", "_address": "address", "_rooms": "specs_bedrooms_raw",
        "_legal": "legal_status"}
#: A crawl on its way into gold.
CRAWL = [*GOLD_INPUT, "load", "gold_loaded_at"]


def latest_crawls(silver: DataFrame, loaded_at=None) -> DataFrame:
    """The crawls that ``silver_to_gold`` makes rows of, from silver with ``load``."""
    return crawls_of(dedupe_listings(silver, keep=("load",)), loaded_at)


def crawls_of(silver: DataFrame, loaded_at=None) -> DataFrame:
    """Silver rows (with ``load``) as crawls, loaded now."""
    return silver.withColumn("gold_loaded_at", load_stamp(loaded_at)).select(*CRAWL)


def stored_rows(crawls: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Gold rows with the side columns; columns named in ``keep`` are carried along."""
    return enrich(crawls).select(*S.GOLD_COLUMNS, *[F.col(of).alias(c) for c, of in SIDE.items()], *keep)


def stored_crawls(gold: DataFrame) -> DataFrame:
    """The crawls that the stored gold's rows were made of."""
    if "_tie" in gold.columns:          # written before the inputs were kept one by one
        gold = gold.withColumns({c: F.col(f"_tie.{of}") for c, of in SIDE.items() if of in TIE})
    if not set(SIDE) <= set(gold.columns):
        raise ValueError("gold has no crawl stamps: rebuild it with a full run first")
    inputs = {of: F.col(c).alias(of) for c, of in SIDE.items()}
    return gold.select(*[inputs.get(c, F.col(c)) for c in CRAWL])


def newer(a: str, b: str) -> Column:
    """Whether crawl ``a`` (a struct of ``stamp``) comes before crawl ``b`` in
    gold's order: the later moment (undated last), then the smaller tie."""
    at, bt = F.col(f"{a}.crawled_at"), F.col(f"{b}.crawled_at")
    return (F.coalesce(at > bt, at.isNotNull() & bt.isNull())
            | (at.eqNullSafe(bt) & (F.col(f"{a}.tie") < F.col(f"{b}.tie"))))


def stamp() -> Column:
    """What decides between crawls, and the landing day."""
    return F.struct("crawled_at", F.struct(*TIE).alias("tie"), "load")


def silver_to_gold(silver: DataFrame, loaded_at=None, latest: bool = True) -> DataFrame:
    gold = enrich(dedupe_listings(silver, latest=latest))
    return (gold.select(*S.GOLD_COLUMNS[:-1])
                .withColumn("gold_loaded_at", load_stamp(loaded_at)))
