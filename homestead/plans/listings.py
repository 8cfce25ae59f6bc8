"""Bronze listing documents derived from the driver's TPC-H-style tables.

Each lineitem is one crawl of listing ``l_orderkey`` (so a listing is crawled
several times and gold's dedupe has real work), enriched with its order,
customer, nation and region. The text fields follow the shapes the listing
rules expect: decimal-comma prices, ``dd/MM/yyyy`` dates, administrative
prefixes and the new/old city suffix, blank titles, single-part addresses and
non-numeric prices — all decided by the data, never by row position.

Scale: orders meet customer first (a quarter of the rows of the whole join), and
lineitem is then hash-partitioned once, on the key
of its only join; both are shuffle joins (both sides grow with the data). AQE
merges small partitions, and the wide text stage never runs in the few tasks of
an under-split file. nation and region are fixed-size dimensions; Spark
broadcasts them on its own size threshold. Texts are made from the narrow rows of
``listing_rows``: what is shuffled or stored on the way is those, not documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table

URL_PREFIX = "https://nha.example/can-ho-"


def _comma2(c: Column) -> Column:
    return F.replace(F.format_string("%.2f", c), F.lit("."), F.lit(","))


def _comma1(c: Column) -> Column:
    return F.replace(F.format_string("%.1f", c), F.lit("."), F.lit(","))


def listing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined source rows (one per lineitem) that a crawl's texts are made of."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_returnflag", "l_linestatus", F.col("l_shipdate").cast("date").alias("l_shipdate")).repartition("l_orderkey")
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_orderpriority")
    c = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", (F.col("c_acctbal") < 0).alias("c_owes"), "c_mktsegment")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    sold = (o.join(c, o.o_custkey == c.c_custkey)
             .join(n, F.col("c_nationkey") == n.n_nationkey)
             .join(r, F.col("n_regionkey") == r.r_regionkey)
             .drop("o_custkey", "c_custkey", "c_nationkey", "n_nationkey", "n_regionkey", "r_regionkey"))
    return li.join(sold, li.l_orderkey == sold.o_orderkey).drop("l_orderkey")


def crawl_texts(rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Flat crawl rows with the raw text fields, from ``listing_rows``; columns
    named in ``keep`` are carried along."""
    district = (F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("Phường "), "n_name"))
                 .when(F.col("o_orderstatus") == "O", F.concat(F.lit("Quận "), "n_name"))
                 .otherwise(F.concat(F.lit("Quận Xã "), "n_name")))
    city = F.concat("r_name", F.when(F.col("c_owes"), F.lit(" cũ")).otherwise(F.lit(" mới")))
    line = F.col("l_linenumber").cast("string")
    return rows.select(
        F.concat(F.lit(URL_PREFIX), F.col("o_orderkey").cast("string")).alias("url"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(" "))
         .otherwise(F.concat_ws(" ", F.lit("Căn hộ"), "c_mktsegment",
                                F.col("o_orderkey").cast("string"))).alias("title"),
        F.when(F.col("o_orderstatus") == "O", F.concat(line, F.lit("A, "), "n_name"))
         .otherwise(F.concat(F.lit("Số "), line, F.lit(", "), "c_mktsegment",
                             F.lit(", "), "n_name")).alias("address"),
        F.when(F.col("o_orderpriority") == "1-URGENT", district)
         .otherwise(F.concat(district, F.lit(", "), city)).alias("address_line_2"),
        F.when(F.col("l_returnflag") == "R", F.lit("Thỏa thuận"))
         .otherwise(F.concat(_comma2(F.col("o_totalprice")), F.lit(" tỷ"))).alias("price_text"),
        F.concat(F.lit("~"), _comma2(F.col("l_extendedprice")), F.lit(" triệu/m²")).alias("unit_text"),
        F.concat(_comma1(F.col("l_quantity")), F.lit(" m²")).alias("area_text"),
        F.concat(line, F.lit(" PN")).alias("bedrooms_text"),
        F.when(F.col("o_orderpriority") == "2-HIGH", F.date_format("o_orderdate", "yyyy-MM-dd"))
         .otherwise(F.date_format("o_orderdate", "dd/MM/yyyy")).alias("posted_text"),
        F.date_format("l_shipdate", "dd/MM/yyyy").alias("expired_text"),
        F.concat(line, F.lit(" phòng")).alias("rooms_text"),
        F.col("c_mktsegment").alias("direction_text"),
        F.when(F.col("l_returnflag") == "A", F.lit("Hợp đồng mua bán"))
         .when(F.col("l_linestatus") == "F", F.lit("Sổ đỏ/ Sổ hồng"))
         .otherwise(F.lit("Đang chờ")).alias("legal_text"),
        F.concat(F.date_format("l_shipdate", "yyyy-MM-dd'T'"),
                 F.lpad(line, 2, "0"), F.lit(":00:00")).alias("crawled_at"),
        *keep,
    )


def listing_crawls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat crawl rows (one per lineitem) with the raw text fields."""
    return crawl_texts(listing_rows(spark, sf_dir))


def listing_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-shaped documents (two string maps) from the crawl rows."""
    return bronze_documents(listing_crawls(spark, sf_dir))


def bronze_documents(flat: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``crawl_texts`` as bronze documents; columns named in ``keep`` are carried along."""
    from .. import schemas as S
    short_keys = list(S.SHORT_INFO_FIELDS)
    spec_keys = list(S.SPECS_FIELDS)
    short_vals = ["price_text", "unit_text", "area_text", "bedrooms_text",
                  "posted_text", "expired_text"]
    spec_vals = ["rooms_text", "direction_text", "legal_text"]

    def mk(keys, vals):
        # every derived value is non-NULL, so each key is always present
        pairs = []
        for k, v in zip(keys, vals):
            pairs += [F.lit(k), F.col(v)]
        return F.create_map(*pairs)

    return flat.select(
        "url", "title", "address", "address_line_2",
        mk(short_keys, short_vals).alias("short_info"),
        mk(spec_keys, spec_vals).alias("specs"),
        F.lit("").alias("description"),
        "crawled_at", *keep,
    )
