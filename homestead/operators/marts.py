"""Market-report marts over a listings fact (or any table).

Every mart pushes filter + aggregate into Spark; only the small result is
ever collected by a caller. Aggregates are hash aggregates with a partial
(map-side) step, so a city or district holding a third of all rows is
pre-reduced on every map task before the shuffle. No unpartitioned window
and no cross join is used anywhere: global bounds (histogram) come from a
scalar subquery that Spark evaluates once and inlines as a literal.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import predicates as P
from ..functions import text as X


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _present(df: DataFrame, c: str) -> Column:
    """The column with NaN as NULL (missing)."""
    return X.nan_to_null(F.col(c)) if dict(df.dtypes)[c] in ("double", "float") else F.col(c)


# --- filters ---------------------------------------------------------------

def filter_listings(df: DataFrame, city=None, price_range=None, unit_price_range=None,
                    bedrooms: Sequence | None = None, city_col: str = "city",
                    price_col: str = "price", unit_col: str = "price_per_m2",
                    bedrooms_col: str = "num_bedrooms") -> DataFrame:
    """City (unless "all"), both price ranges (inclusive; NULL price or unit
    price is dropped whenever a range is given), bedroom list (if any)."""
    conds = [P.equals_unless_all(city_col, city)]
    if price_range is not None:
        conds.append(P.in_range(price_col, *price_range))
    if unit_price_range is not None:
        conds.append(P.in_range(unit_col, *unit_price_range))
    conds.append(P.in_list(bedrooms_col, bedrooms))
    return df.filter(P.all_of(conds))


# --- scalar marts ------------------------------------------------------------

def header_kpis(df: DataFrame, stamp_col: str = "gold_loaded_at") -> DataFrame:
    """Row count and freshness (max load time; NULL when empty)."""
    return df.agg(F.count(F.lit(1)).alias("total_rows"),
                  F.max(stamp_col).alias("last_updated"))


def bounds(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Min and max of each column in one pass (NaN skipped, like NULL)."""
    aggs = []
    for c in cols:
        v = _present(df, c)
        aggs += [F.min(v).alias(f"min_{c}"), F.max(v).alias(f"max_{c}")]
    return df.agg(*aggs)


def distinct_sorted(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct non-NULL values (code-point order)."""
    return df.select(col).filter(F.col(col).isNotNull()).distinct().orderBy(col)


def listing_kpis(df: DataFrame, price_col: str = "price", area_col: str = "area_m2",
                 flag_col: str = "has_legal_docs") -> DataFrame:
    """Count, mean price and area (2 decimals, NaN skipped), flag total."""
    return df.agg(
        F.count(F.lit(1)).alias("n_listings"),
        F.round(F.avg(X.nan_to_null(F.col(price_col))), 2).alias("avg_price"),
        F.round(F.avg(X.nan_to_null(F.col(area_col))), 2).alias("avg_area"),
        F.coalesce(F.sum(flag_col), F.lit(0)).cast("long").alias("n_flagged"),
    )


# --- grouped marts -----------------------------------------------------------

def group_mean(df: DataFrame, key: str, value: str, alias: str = "mean_value") -> DataFrame:
    """Mean of ``value`` per non-NULL ``key`` (NULL and NaN values skipped)."""
    return (df.filter(F.col(key).isNotNull())
              .groupBy(key).agg(F.avg(X.nan_to_null(F.col(value))).alias(alias)))


def topk_mean(df: DataFrame, key: str, value: str, k: int = S.TOP_K,
              alias: str = "mean_value") -> DataFrame:
    """Top-k groups by mean, descending (NULL means last, key breaks ties).
    Plans as a partial+final aggregate followed by TakeOrderedAndProject."""
    return (group_mean(df, key, value, alias)
            .orderBy(F.col(alias).desc_nulls_last(), F.col(key).asc_nulls_first())
            .limit(k))


def share_two_way(df: DataFrame, flag_col: str,
                  labels: tuple[str, str] = ("flagged", "rest")) -> DataFrame:
    """Two rows: flag sum and (row count - flag sum)."""
    tot = df.agg(F.coalesce(F.sum(flag_col), F.lit(0)).cast("long").alias("a"),
                 F.count(F.lit(1)).alias("n"))
    return tot.select(F.inline(F.array(
        F.struct(F.lit(labels[0]).alias("label"), F.col("a").alias("n_rows")),
        F.struct(F.lit(labels[1]).alias("label"), (F.col("n") - F.col("a")).alias("n_rows")),
    )))


def histogram(df: DataFrame, value: str, bins: int = S.HISTOGRAM_BINS) -> DataFrame:
    """Equal-width histogram over [min, max]; the max lands in the last bin.
    Empty bins are absent; NULL and NaN are skipped. Bounds come from one scalar subquery (evaluated
    once, inlined as a literal): no cross join, no unpartitioned window."""
    df = df.select(_present(df, value).alias(value))
    v = F.col(value)
    bounds_row = df.select(F.struct(F.min(v).alias("lo"), F.max(v).alias("hi"))).scalar()
    lo, hi = F.col("_b.lo"), F.col("_b.hi")
    width = (hi - lo) / F.lit(float(bins))
    raw = F.floor((v - lo) / width)
    idx = F.when(hi == lo, F.lit(0)).otherwise(F.least(raw, F.lit(bins - 1))).cast("int")
    return (df.select(v, bounds_row.alias("_b"))
              .filter(v.isNotNull())
              .groupBy(idx.alias("bin"), F.col("_b"))
              .agg(F.count(F.lit(1)).alias("n_rows"))
              .select("bin",
                      (lo + F.col("bin") * width).alias("bin_lo"),
                      (lo + (F.col("bin") + 1) * width).alias("bin_hi"),
                      "n_rows"))


# --- projections -------------------------------------------------------------

SCATTER_COLUMNS = ("area_m2", "price", "city", "title", "district", "price_per_m2")
LOOKUP_COLUMNS = ("title", "city", "district", "price", "area_m2", "num_bedrooms", "url")


def scatter_projection(df: DataFrame, cols: Sequence[str] = SCATTER_COLUMNS) -> DataFrame:
    return df.select(*cols)


def lookup_projection(df: DataFrame, cols: Sequence[str] = LOOKUP_COLUMNS) -> DataFrame:
    return df.select(*cols)
