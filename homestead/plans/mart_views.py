"""Market marts kept up to date from gold's changed buckets.

The view table has one row per (city, district, bedrooms) with counts and exact
decimal sums, from which the count, mean, flag and top-k marts follow for any
city or bedroom filter. A refresh compares the bucket copies that the view was
made of (kept in its version's note) with gold's current ones; the changed
buckets are read twice, the old copies to subtract and the new ones to add, and
only their groups' sums are merged into the view. Rows that a run left as they
were cancel out, so no change log is kept, and a refresh may catch up on
several runs, or be run again, at any time.

Sums are decimals: what was added is subtracted to the last digit. Where an old
copy has been removed meanwhile, or the view is new, all of gold is read.

Cases: no gold gives no view; NaN and NULL values count as missing; infinite
values and those beyond 10^22 raise; a group whose last listing goes is
dropped; NULL is a group of its own.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import predicates as P
from ..functions import text as X
from ..sources.tables import (bucket_copies, bucket_versions, current_version, last_note, publish_version,
                              read_versioned)

GRAIN = ["city", "district", "num_bedrooms"]
#: Summed columns and what their sums are called.
VALUES = {"price": "price", "area_m2": "area", "price_per_m2": "unit"}
TOTALS = ["n", "n_flagged", *(f"{k}_{v}" for v in VALUES.values() for k in ("n", "sum"))]
EXACT = "decimal(30,8)"


def totals(gold: DataFrame, sign: int = 1) -> DataFrame:
    """One row per group: how many listings, how many flagged, and count and
    exact sum of each value; negated with ``sign`` -1."""
    aggs = [F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("has_legal_docs"), F.lit(0)).cast("long").alias("n_flagged")]
    for c, name in VALUES.items():
        v = X.nan_to_null(F.col(c))
        aggs += [F.count(v).alias(f"n_{name}"), F.coalesce(F.sum(v.cast(EXACT)), F.lit(0)).cast("decimal(38,8)").alias(f"sum_{name}")]
    out = gold.groupBy(*GRAIN).agg(*aggs)
    return out if sign == 1 else out.select(*GRAIN, *[(-F.col(c)).alias(c) for c in TOTALS])


def _summed(df: DataFrame) -> DataFrame:
    return df.groupBy(*GRAIN).agg(*[F.sum(c).cast(df.schema[c].dataType).alias(c) for c in TOTALS])


@dataclass
class Refresh:
    version: int                  # of the view
    read: list[str]               # the bucket directories that were read
    whole: bool                   # all of gold was read


def refresh(spark: SparkSession, gold_root: str, view_root: str) -> Refresh:
    """Bring the view to gold's current buckets and publish it as its next
    version. Of two refreshes at a time one fails (``PublishConflict``)."""
    base = current_version(spark, view_root)
    now = bucket_versions(spark, gold_root)
    note = last_note(spark, view_root) if base else None
    held = (note or {}).get("buckets", {})
    if not now or held == now:
        return Refresh(base, [], False)
    changed = {b: v for b, v in now.items() if held.get(b) != v}
    old = bucket_copies(spark, gold_root, {b: held[b] for b in changed if b in held}) if note else None
    whole = old is None or not set(held) <= set(now)
    new = bucket_copies(spark, gold_root, now if whole else changed)
    if new is None:
        raise FileNotFoundError(f"a bucket of {gold_root} went while it was listed: refresh again")
    columns = [*GRAIN, "has_legal_docs", *VALUES]
    view = totals(spark.read.schema(_schema(columns)).parquet(*new))
    if not whole:
        parts = view.unionByName(read_versioned(spark, f"{view_root}"))
        if old:
            parts = parts.unionByName(totals(spark.read.schema(_schema(columns)).parquet(*old), -1))
        view = _summed(parts).where("n <> 0")
    publish_version(view, view_root, base=base, note={"buckets": now})
    return Refresh(base + 1, [*new, *(() if whole else old)], whole)


def _schema(columns: Sequence[str]):
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.GOLD_SCHEMA.fields if f.name in columns)


def read_view(spark: SparkSession, view_root: str, city=None, bedrooms: Sequence | None = None) -> DataFrame:
    """The view's groups, of one city (unless "all") and these bedrooms (if any)."""
    view = read_versioned(spark, view_root)
    if view is None:
        raise FileNotFoundError(f"no view under {view_root}: refresh it first")
    return view.filter(P.all_of([P.equals_unless_all("city", city), P.in_list("num_bedrooms", bedrooms)]))


def _mean(name: str):
    total, n = F.sum(f"sum_{name}").cast("double"), F.sum(f"n_{name}")
    return F.when(n > 0, total / n)


def kpis(view: DataFrame) -> DataFrame:
    """As ``marts.listing_kpis`` over the listings."""
    return view.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_listings"), F.round(_mean("price"), 2).alias("avg_price"),
                    F.round(_mean("area"), 2).alias("avg_area"), F.coalesce(F.sum("n_flagged"), F.lit(0)).alias("n_flagged"))


def topk_mean(view: DataFrame, key: str, value: str, k: int = S.TOP_K, alias: str = "mean_value") -> DataFrame:
    """As ``marts.topk_mean`` by a column of the grain."""
    return (view.filter(F.col(key).isNotNull()).groupBy(key).agg(_mean(VALUES[value]).alias(alias))
            .orderBy(F.col(alias).desc_nulls_last(), F.col(key).asc_nulls_first()).limit(k))


def share_two_way(view: DataFrame, labels: tuple[str, str] = ("flagged", "rest")) -> DataFrame:
    """Flagged listings and the others."""
    sums = view.agg(F.coalesce(F.sum("n_flagged"), F.lit(0)).alias("a"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    return sums.select(F.inline(F.array(
        F.struct(F.lit(labels[0]).alias("label"), F.col("a").alias("n_rows")),
        F.struct(F.lit(labels[1]).alias("label"), (F.col("n") - F.col("a")).alias("n_rows")))))
