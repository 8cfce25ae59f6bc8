"""The report flow on the gold fact derived from the driver tables."""

from pyspark.sql import functions as F

from homestead.plans.catalog import gold_listings
from homestead.plans.report import market_report

from parity import SF001


def test_report_all_cities(spark):
    gold = gold_listings(spark, SF001)
    rep = market_report(gold)
    n_all = gold.count()
    assert rep["header"].first().total_rows == n_all
    cities = [r.city for r in rep["cities"].collect()]
    assert cities == sorted(cities)
    # default ranges = bounds: only rows with NULL price / unit price are dropped
    kept = gold.filter(F.col("price").isNotNull() & F.col("price_per_m2").isNotNull()).count()
    assert rep["kpis"].first().n_listings == kept == rep["lookup"].count()
    assert sum(r.n_rows for r in rep["share"].collect()) == kept
    assert set(rep["distribution"].columns) >= {"city", "q1", "median", "q3"}
    assert rep["top_price"].count() <= 15


def test_report_single_city(spark):
    gold = gold_listings(spark, SF001)
    city = gold.select("city").filter("city is not null").first().city
    rep = market_report(gold, city=city, bedrooms=[1, 2, 3])
    hist = rep["distribution"].collect()
    assert "bin" in rep["distribution"].columns
    assert sum(r.n_rows for r in hist) == rep["kpis"].first().n_listings
    assert {r.city for r in rep["lookup"].collect()} <= {city}
