"""Bronze -> silver: one narrow stage (project + filter), no shuffle. Where
rows are shuffled before they are written, that stage is cut in two: ``narrow``
drops unfit documents and keeps the raw fields, ``widen`` derives the rest.

Rule order matters: the ward test runs on the district *after* the prefix is
stripped, so ``Quận Phường X`` survives as ``Phường X`` while ``Quận 1``
becomes ``1`` and is dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import predicates as P
from ..functions import text as X


def bronze_columns(bronze: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed projection of the bronze document (map fields pulled out)."""
    cols = [F.col(c) for c in ("url", "title", "address", "address_line_2", "description")]
    cols.append(X.parse_timestamp("crawled_at").alias("crawled_at"))
    for key, name in S.SHORT_INFO_FIELDS.items():
        cols.append(X.struct_or_map_field(bronze, "short_info", key).alias(name))
    for key, name in S.SPECS_FIELDS.items():
        cols.append(X.struct_or_map_field(bronze, "specs", key).alias(name))
    return bronze.select(*cols, *keep)


def _fit(bronze: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """The documents that pass the silver rules, with their district and day."""
    df = bronze_columns(bronze, keep)
    df = df.filter(P.not_blank("title") & P.min_parts("address_line_2", 2))
    df = df.withColumn("district", _district()).filter(P.is_ward("district"))
    return df.withColumn("dt", X.to_day("crawled_at"))


def _district() -> Column:
    return X.strip_district_prefix(X.part("address_line_2", 1))


def _derived(df: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    df = df.withColumns({
        "city": X.strip_city_suffix(X.part("address_line_2", 2)),
        "price": X.locale_number("price_raw"),
        "area_m2": X.locale_number("area_raw"),
        "price_per_m2": X.locale_number("price_per_m2_raw"),
        "posted_date": X.parse_date("posted_date_str"),
    })
    return df.select(*S.SILVER_COLUMNS, *keep)


def bronze_to_silver(bronze: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Cleaned, typed silver rows; partition column ``dt`` from ``crawled_at``.
    Bronze columns named in ``keep`` are carried along."""
    return _derived(_fit(bronze, keep), keep)


def narrow(bronze: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The rows of ``bronze_to_silver`` before anything but ``dt`` is derived:
    what is shuffled before silver is written."""
    return _fit(bronze, keep).drop("district")


def widen(rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``bronze_to_silver`` of the rows that ``narrow`` leaves."""
    return _derived(rows.withColumn("district", _district()), keep)
