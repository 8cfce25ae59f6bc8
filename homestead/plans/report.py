"""The market report as DataFrames (the dashboard's data, no rendering).

Flow: header KPIs over the whole fact -> city options -> city filter ->
price / unit-price bounds (the default ranges) and bedroom options over the
city-filtered set -> range and bedroom filters -> KPIs, top-15 wards by mean
price and by mean unit price, scatter rows, legal-docs share, the price
distribution (box statistics per city when all cities are shown, a 20-bin
histogram for a single city) and the lookup table.

The tables are lazy DataFrames, but for two jobs that run while the report is
built: the bounds (one row) are collected, to turn "no range chosen" into the
data's own min/max as the source did, and box statistics checkpoint their value
table.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame

from .. import schemas as S
from ..operators import marts as M
from ..operators.quantiles import box_stats


def market_report(gold: DataFrame, city: str = S.ALL_SENTINEL,
                  price_range: tuple | None = None, unit_price_range: tuple | None = None,
                  bedrooms: Sequence[int] | None = None) -> dict[str, DataFrame]:
    out: dict[str, DataFrame] = {
        "header": M.header_kpis(gold),
        "cities": M.distinct_sorted(gold, "city"),
    }
    in_city = M.filter_listings(gold, city=city)
    out["bounds"] = M.bounds(in_city, ["price", "price_per_m2"])
    out["bedroom_options"] = M.distinct_sorted(in_city, "num_bedrooms")
    if price_range is None or unit_price_range is None:
        b = out["bounds"].first()
        price_range = price_range or (b.min_price, b.max_price)
        unit_price_range = unit_price_range or (b.min_price_per_m2, b.max_price_per_m2)
    sel = M.filter_listings(in_city, price_range=price_range,
                            unit_price_range=unit_price_range, bedrooms=bedrooms)
    out["kpis"] = M.listing_kpis(sel)
    out["top_price"] = M.topk_mean(sel, "district", "price", alias="mean_price")
    out["top_unit_price"] = M.topk_mean(sel, "district", "price_per_m2", alias="mean_unit_price")
    out["scatter"] = M.scatter_projection(sel)
    out["share"] = M.share_two_way(sel, "has_legal_docs", ("with_docs", "unknown"))
    if city is None or city == S.ALL_SENTINEL:
        out["distribution"] = box_stats(sel, "city", "price")
    else:
        out["distribution"] = M.histogram(sel, "price", S.HISTOGRAM_BINS)
    out["lookup"] = M.lookup_projection(sel)
    return out
