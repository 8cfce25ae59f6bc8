"""Schemas of the bronze / silver / gold layers and the fixed values the
listing rules depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These must equal the source system's values for the results
# to be right; they are data, stated once, in their natural order.
# ---------------------------------------------------------------------------

# Attribute labels shown on a listing page (Vietnamese), map -> key -> silver column.
SHORT_INFO_FIELDS = {
    "Khoảng giá": "price_raw",
    "Khoảng giá(ext)": "price_per_m2_raw",
    "Diện tích": "area_raw",
    "Phòng ngủ": "bedrooms_raw",
    "Ngày đăng": "posted_date_str",
    "Ngày hết hạn": "expired_date_str",
}
SPECS_FIELDS = {
    "Số phòng ngủ": "specs_bedrooms_raw",
    "Hướng nhà": "house_direction",
    "Pháp lý": "legal_status",
}
# Suffix appended to a short-info label to store its extension value.
EXT_SUFFIX = "(ext)"

# Administrative prefixes removed from the district, case-sensitive.
DISTRICT_PREFIX_PATTERN = r"^(Quận|Huyện|Thị xã)\s+"
# "new" / "old" suffix removed from the city.
CITY_SUFFIX_PATTERN = r"\s+(mới|cũ)$"
# Ward-level rows are kept: district starts with one of these words.
WARD_PATTERN = r"^(Xã|Phường)\s"
# Keywords that mark a listing as having legal documents (matched lower-cased).
LEGAL_KEYWORDS = ("sổ", "đỏ", "hồng")
# Address parts skipped when looking for the project name: short ASCII tokens
# and house-number parts.
SHORT_TOKEN_PATTERN = r"^[0-9/\sA-Za-z]{1,6}$"
HOUSE_NUMBER_PREFIX = "số"
# Report: the "all cities" sentinel and the top-k size.
ALL_SENTINEL = "Tất cả"
TOP_K = 15
HISTOGRAM_BINS = 20
# Frontier defaults.
PENDING = "pending"
CRAWLED = "crawled"
FIRST_PAGE = 1
# Dates.
POSTED_DATE_FORMAT = "dd/MM/yyyy"
PARTITION_DATE_FORMAT = "yyyy-MM-dd"

# ---------------------------------------------------------------------------
# Layer schemas
# ---------------------------------------------------------------------------

STR = T.StringType()
STR_MAP = T.MapType(T.StringType(), T.StringType())

BRONZE_SCHEMA = T.StructType([
    T.StructField("url", STR),
    T.StructField("title", STR),
    T.StructField("address", STR),
    T.StructField("address_line_2", STR),
    T.StructField("short_info", STR_MAP),
    T.StructField("specs", STR_MAP),
    T.StructField("description", STR),
    T.StructField("crawled_at", STR),
    # Malformed files become a row with only this column set.
    T.StructField("_corrupt_record", STR),
])

SILVER_COLUMNS = [
    "url", "title", "address", "address_line_2", "description", "crawled_at",
    "price_raw", "price_per_m2_raw", "area_raw", "bedrooms_raw",
    "posted_date_str", "expired_date_str",
    "specs_bedrooms_raw", "house_direction", "legal_status",
    "district", "city", "price", "area_m2", "price_per_m2", "posted_date", "dt",
]

GOLD_KEY = "url"
GOLD_COLUMNS = [
    "url", "project_name", "title", "district", "city",
    "price", "area_m2", "price_per_m2", "num_bedrooms",
    "house_direction", "has_legal_docs", "posted_date", "dt",
    "gold_loaded_at",
]

GOLD_SCHEMA = T.StructType([
    T.StructField("url", STR, False),
    T.StructField("project_name", STR),
    T.StructField("title", STR),
    T.StructField("district", STR),
    T.StructField("city", STR),
    T.StructField("price", T.DoubleType()),
    T.StructField("area_m2", T.DoubleType()),
    T.StructField("price_per_m2", T.DoubleType()),
    T.StructField("num_bedrooms", T.IntegerType()),
    T.StructField("house_direction", STR),
    T.StructField("has_legal_docs", T.IntegerType()),
    T.StructField("posted_date", T.DateType()),
    T.StructField("dt", T.DateType()),
    T.StructField("gold_loaded_at", T.TimestampNTZType()),
])

FRONTIER_SCHEMA = T.StructType([
    T.StructField("url", STR, False),
    T.StructField("status", STR),
    T.StructField("created_at", T.TimestampNTZType()),
])

CRAWL_STATE_SCHEMA = T.StructType([
    T.StructField("location_name", STR, False),
    T.StructField("current_page", T.IntegerType()),
])

LOCATION_SCHEMA = T.StructType([
    T.StructField("name", STR, False),
    T.StructField("url", STR),
])

PAGES_SCHEMA = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", STR),
    T.StructField("html", STR),
])
