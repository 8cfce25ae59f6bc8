"""DuckDB oracle SQL, one statement per registered query (same column names).
Written independently of the Spark code: a mismatch means one side is wrong."""

from __future__ import annotations

from .oracle_listings import GOLD_SQL, SILVER_SQL

ORACLE: dict[str, str] = {}

ORACLE["listings_silver"] = SILVER_SQL

ORACLE["listings_gold"] = GOLD_SQL

ORACLE["report_topk_price"] = f"""
WITH gold AS ({GOLD_SQL})
SELECT district, round(avg(price), 6) AS mean_price
FROM gold
WHERE price BETWEEN 100000.0 AND 400000.0 AND price_per_m2 BETWEEN 2000.0 AND 60000.0 AND district IS NOT NULL
GROUP BY district
ORDER BY avg(price) DESC NULLS LAST, district ASC NULLS FIRST
LIMIT 15
"""

URL = "'https://nha.example/can-ho-'"

ORACLE["json_field_tolerant"] = """
SELECT event_id, json_extract_string(props, '$.k') AS k,
       json_extract_string(props, '$.absent') AS absent
FROM events
"""

ORACLE["not_blank_filter"] = """
SELECT doc_id, lang, n_chars FROM documents
WHERE text IS NOT NULL AND trim(text, ' ') <> ''
"""

ORACLE["split_address_pair"] = r"""
WITH a AS (
  SELECT c_custkey,
         CASE WHEN c_acctbal >= 0 THEN n_name || ', ' || r_name || ' mới' ELSE n_name END AS a2
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)
SELECT c_custkey, trim(string_split(a2, ',')[1], ' ') AS district,
       regexp_replace(trim(string_split(a2, ',')[2], ' '), '\s+(mới|cũ)$', '') AS city
FROM a WHERE len(string_split(a2, ',')) >= 2
"""

ORACLE["strip_prefix_suffix"] = r"""
WITH s AS (
  SELECT p_partkey,
         regexp_replace(regexp_replace(p_name, '^(small|large|old)\s+', ''), '\s+(gear|rod)$', '') AS name
  FROM part
)
SELECT p_partkey, name FROM s WHERE regexp_matches(name, '^(red|hot|blue|cold|new)\s')
"""

ORACLE["locale_number"] = r"""
WITH t AS (
  SELECT o_orderkey,
    CASE WHEN o_orderstatus = 'F' THEN replace(printf('%.2f', o_totalprice), '.', ',') || ' tỷ'
         WHEN o_orderstatus = 'O' THEN replace(printf('%.2f', o_totalprice), '.', ',') || ' - '
                                       || replace(printf('%.2f', o_totalprice * 2), '.', ',') || ' tỷ'
         ELSE 'Thỏa thuận' END AS price_text
  FROM orders
)
SELECT o_orderkey, price_text,
       TRY_CAST(replace(regexp_replace(price_text, '[^0-9,]', '', 'g'), ',', '.') AS DOUBLE) AS price
FROM t
"""

ORACLE["digits_int"] = """
SELECT c_custkey,
       TRY_CAST(regexp_replace(c_name, '[^0-9]', '', 'g') AS INTEGER) AS name_number,
       TRY_CAST(regexp_replace(c_mktsegment, '[^0-9]', '', 'g') AS INTEGER) AS segment_number
FROM customer
"""

ORACLE["parse_date"] = """
WITH t AS (
  SELECT o_orderkey, o_orderdate,
    CASE WHEN o_orderpriority = '2-HIGH' THEN strftime(o_orderdate, '%Y-%m-%d')
         ELSE strftime(o_orderdate, '%d/%m/%Y') END AS posted_text
  FROM orders
)
SELECT o_orderkey, posted_text, CAST(try_strptime(posted_text, '%d/%m/%Y') AS DATE) AS posted_date,
       CAST(o_orderdate AS DATE) AS order_day
FROM t
"""

ORACLE["keyword_flag"] = """
SELECT p_partkey,
  CASE WHEN contains(lower(p_name), 'red') OR contains(lower(p_name), 'hot')
         OR contains(lower(p_name), 'gear') THEN 1 ELSE 0 END AS flag
FROM part
"""

ORACLE["first_meaningful_part"] = r"""
WITH t AS (
  SELECT p_partkey, concat_ws(', ', CAST(p_size AS VARCHAR), p_type, p_name, p_brand) AS address
  FROM part
)
SELECT p_partkey, address,
  trim(list_filter(string_split(address, ','),
       lambda x: NOT (regexp_matches(trim(x, ' '), '^[0-9/\sA-Za-z]{1,6}$')
                      OR starts_with(lower(trim(x, ' ')), 'small')))[1], ' ') AS project_name
FROM t
"""

ORACLE["numeric_coerce"] = """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k_num,
       TRY_CAST(event_type AS DOUBLE) AS type_num
FROM events
"""

ORACLE["latest_per_key"] = """
SELECT * FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST,
  event_id ASC NULLS FIRST, event_type ASC NULLS FIRST, value ASC NULLS FIRST,
  props ASC NULLS FIRST) = 1
"""

ORACLE["upsert"] = """
WITH t AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
s AS (SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus, o_totalprice * 2 AS o_totalprice,
             o_orderdate, o_orderpriority
      FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')
SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey)
UNION ALL SELECT * FROM s
"""

FRONTIER_SQL = f"""
SELECT {URL} || CAST(o_orderkey AS VARCHAR) AS url,
       CASE WHEN o_orderstatus = 'F' THEN 'crawled' ELSE 'pending' END AS status,
       o_orderdate AS created_at
FROM orders
"""

ORACLE["insert_ignore"] = f"""
WITH t AS ({FRONTIER_SQL} WHERE o_orderdate < TIMESTAMP '2000-01-01'),
n AS (SELECT DISTINCT {URL} || CAST(l_orderkey AS VARCHAR) AS url FROM lineitem)
SELECT * FROM t
UNION ALL
SELECT url, 'pending' AS status, TIMESTAMP '2026-01-01 00:00:00' AS created_at
FROM n WHERE url NOT IN (SELECT url FROM t)
"""

ORACLE["insert_ignore_payload"] = f"""
WITH t AS ({FRONTIER_SQL} WHERE o_orderdate < TIMESTAMP '2000-01-01'),
n AS (SELECT {URL} || CAST(l_orderkey AS VARCHAR) AS url, min(l_shipdate) AS created_at FROM lineitem GROUP BY l_orderkey)
SELECT * FROM t
UNION ALL
SELECT url, 'pending' AS status, CAST(created_at AS TIMESTAMP) AS created_at
FROM n WHERE url NOT IN (SELECT url FROM t)
"""

ORACLE["upsert_repeated_source"] = """
WITH t AS (SELECT o_orderkey, o_totalprice AS price FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
s AS (SELECT l_orderkey AS o_orderkey, l_extendedprice AS price FROM lineitem
      QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_extendedprice ASC) = 1)
SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey)
UNION ALL SELECT * FROM s
"""

ORACLE["insert_ignore_count"] = f"""
WITH t AS ({FRONTIER_SQL} WHERE o_orderdate < TIMESTAMP '2000-01-01'),
n AS (SELECT DISTINCT {URL} || CAST(l_orderkey AS VARCHAR) AS url FROM lineitem)
SELECT CAST(count(*) AS BIGINT) AS n_new FROM n WHERE url NOT IN (SELECT url FROM t)
"""

ORACLE["update_status"] = f"""
WITH f AS ({FRONTIER_SQL}),
d AS (SELECT DISTINCT {URL} || CAST(l_orderkey AS VARCHAR) AS url FROM lineitem WHERE l_linestatus = 'F')
SELECT f.url, CASE WHEN d.url IS NOT NULL THEN 'crawled' ELSE f.status END AS status, f.created_at
FROM f LEFT JOIN d ON f.url = d.url
"""

ORACLE["key_violations"] = """
SELECT slug, CAST(count(*) AS BIGINT) AS n_rows
FROM (SELECT list_extract(string_split(trim(url, '/'), '/'), -1) AS slug FROM pages)
GROUP BY slug HAVING count(*) > 1 OR slug IS NULL
"""

ORACLE["url_slug"] = """
SELECT page_id, list_extract(string_split(trim(url, '/'), '/'), -1) AS slug FROM pages
"""

ORACLE["queue_take"] = f"""
SELECT * FROM ({FRONTIER_SQL}) WHERE status = 'pending'
ORDER BY created_at ASC NULLS LAST, url ASC NULLS LAST LIMIT 10
"""

PLACE_STATE_SQL = """
SELECT n_name AS location_name, CAST(sum(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END) AS INTEGER) AS current_page
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name
"""

PLACE_PAGES_SQL = f"""
SELECT p.name, p.url, CAST(coalesce(s.current_page, 1) AS INTEGER) AS current_page
FROM (SELECT n_name AS name, 'https://nha.example/ban-' || lower(n_name) AS url FROM nation
      UNION ALL
      SELECT 'Region ' || r_name, 'https://nha.example/ban-' || lower(r_name) || '-region' FROM region) p
LEFT JOIN ({PLACE_STATE_SQL}) s ON s.location_name = p.name
"""

ORACLE["state_lookup_default"] = f"""
SELECT name, current_page,
       CASE WHEN current_page > 1 THEN url || '/p' || CAST(current_page AS VARCHAR) ELSE url END AS page_url
FROM ({PLACE_PAGES_SQL})
"""

ORACLE["cursor_advance"] = f"""
WITH l AS (
  SELECT n_name AS name, sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS n_links
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name
)
SELECT p.name AS location_name,
       CAST(CASE WHEN coalesce(l.n_links, 0) > 0 THEN p.current_page + 1 ELSE 1 END AS INTEGER) AS current_page,
       CAST(coalesce(l.n_links, 0) AS BIGINT) AS n_links
FROM ({PLACE_PAGES_SQL}) p LEFT JOIN l ON l.name = p.name
"""

ORACLE["cursor_saved"] = f"SELECT location_name, current_page FROM ({ORACLE['cursor_advance']})"

ANCHORS = r"""regexp_extract_all(html, '<a\s[^>]*>', 0)"""
HREFS = ("list_filter(list_transform(" + ANCHORS +
         r""", lambda t: regexp_extract(t, '\shref\s*=\s*["'']([^"'']*)["'']', 1)), lambda h: h <> '')""")

ORACLE["quarantine_few_links"] = f"""
SELECT page_id, url, CAST(len({HREFS}) AS BIGINT) AS n_links
FROM pages WHERE len({HREFS}) < 6
"""

ORACLE["extract_links"] = f"""
WITH h AS (
  SELECT page_id, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS dom, {HREFS} AS hs FROM pages
), e AS (
  SELECT page_id, dom, unnest(range(len(hs))) AS pos, unnest(hs) AS href FROM h
)
SELECT page_id, CAST(pos AS INTEGER) AS pos,
       CASE WHEN starts_with(href, 'http') THEN href ELSE dom || href END AS link
FROM e WHERE NOT (starts_with(href, 'http') AND NOT contains(href, dom))
"""

ORACLE["extract_heading"] = r"""
WITH t AS (
  SELECT page_id, regexp_replace(regexp_extract(html, '(?s)<h1(?:\s[^>]*)?>(.*?)</h1>', 1), '<[^>]*>', '', 'g') AS raw
  FROM pages WHERE regexp_matches(html, '<h1[\s>]')
)
SELECT page_id,
  regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(raw,
      '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&quot;?', '"', 'g'), '&#0*39;?', '''', 'g'), '&amp;?', '&', 'g'),
      '^\s+|\s+$', '', 'g') AS title
FROM t
"""

ORACLE["header_kpi"] = """
SELECT CAST(count(*) AS BIGINT) AS total_rows, max(ts) AS last_updated FROM events
"""

GOLD = f"WITH gold AS ({GOLD_SQL})"

ORACLE["filter_bounds"] = f"""{GOLD}
SELECT min(price) AS min_price, max(price) AS max_price,
       min(price_per_m2) AS min_price_per_m2, max(price_per_m2) AS max_price_per_m2
FROM gold WHERE city = 'ASIA'
"""

ORACLE["distinct_sorted"] = f"""{GOLD}
SELECT DISTINCT city FROM gold WHERE city IS NOT NULL ORDER BY city
"""

ORACLE["distinct_bedrooms"] = f"""{GOLD}
SELECT DISTINCT num_bedrooms FROM gold WHERE city = 'ASIA' AND num_bedrooms IS NOT NULL ORDER BY 1
"""

ORACLE["marts_maintained"] = f"""{GOLD}
SELECT city, district, num_bedrooms, CAST(count(*) AS BIGINT) AS n_listings,
       CAST(coalesce(sum(has_legal_docs), 0) AS BIGINT) AS n_flagged, round(avg(price), 6) AS mean_price,
       round(avg(area_m2), 6) AS mean_area, round(avg(price_per_m2), 6) AS mean_unit
FROM gold GROUP BY city, district, num_bedrooms
"""

ORACLE["marts_maintained_topk"] = f"""{GOLD}
SELECT district, round(avg(price), 6) AS mean_price FROM gold WHERE district IS NOT NULL
GROUP BY district ORDER BY avg(price) DESC NULLS LAST, district ASC NULLS FIRST LIMIT 15
"""

FILTERED = """price IS NOT NULL AND price BETWEEN 100000.0 AND 400000.0
  AND price_per_m2 IS NOT NULL AND price_per_m2 BETWEEN 2000.0 AND 60000.0"""

ORACLE["filtered_kpis"] = f"""{GOLD}
SELECT CAST(count(*) AS BIGINT) AS n_listings, round(avg(price), 2) AS avg_price,
       round(avg(area_m2), 2) AS avg_area, CAST(coalesce(sum(has_legal_docs), 0) AS BIGINT) AS n_flagged
FROM gold WHERE {FILTERED} AND num_bedrooms IN (1, 2, 3)
"""

ORACLE["topk_mean"] = """
SELECT n_name, round(avg(c_acctbal), 6) AS mean_value
FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE n_name IS NOT NULL
GROUP BY n_name ORDER BY avg(c_acctbal) DESC NULLS LAST, n_name ASC NULLS FIRST LIMIT 15
"""

ORACLE["topk_mean_unit"] = """
SELECT p_brand, round(avg(l_extendedprice / l_quantity), 6) AS mean_value
FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE p_brand IS NOT NULL
GROUP BY p_brand ORDER BY avg(l_extendedprice / l_quantity) DESC NULLS LAST, p_brand ASC NULLS FIRST
LIMIT 15
"""

ORACLE["topk_mean_unit_listings"] = f"""{GOLD}
SELECT district, round(avg(price_per_m2), 6) AS mean_unit_price
FROM gold WHERE {FILTERED} AND district IS NOT NULL
GROUP BY district ORDER BY avg(price_per_m2) DESC NULLS LAST, district ASC NULLS FIRST LIMIT 15
"""

ORACLE["share_two_way"] = """
SELECT 'purchase' AS label, CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS n_rows FROM events
UNION ALL
SELECT 'other', CAST(count(*) - sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) FROM events
"""

ORACLE["share_legal_docs"] = f"""{GOLD}
SELECT 'with_docs' AS label, CAST(coalesce(sum(has_legal_docs), 0) AS BIGINT) AS n_rows FROM gold WHERE {FILTERED}
UNION ALL
SELECT 'unknown', CAST(count(*) - coalesce(sum(has_legal_docs), 0) AS BIGINT) FROM gold WHERE {FILTERED}
"""


def _box_sql(source: str, group: str, value: str, quartiles: str) -> str:
    return f"""
WITH src AS ({source}),
q AS ({quartiles}),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo_f, q3 + 1.5 * (q3 - q1) AS hi_f FROM q),
w AS (
  SELECT f.{group},
    min(CASE WHEN s.{value} >= lo_f AND s.{value} <= hi_f THEN s.{value} END) AS lower_whisker,
    max(CASE WHEN s.{value} >= lo_f AND s.{value} <= hi_f THEN s.{value} END) AS upper_whisker,
    CAST(count(CASE WHEN NOT (s.{value} >= lo_f AND s.{value} <= hi_f) THEN 1 END) AS BIGINT) AS n_outliers
  FROM src s JOIN f ON s.{group} = f.{group} WHERE s.{value} IS NOT NULL GROUP BY f.{group}
)
SELECT f.{group}, f.n, round(f.q1, 6) AS q1, round(f.median, 6) AS median, round(f.q3, 6) AS q3,
       round(w.lower_whisker, 6) AS lower_whisker, round(w.upper_whisker, 6) AS upper_whisker, w.n_outliers
FROM f JOIN w ON f.{group} = w.{group}
"""


def _quartiles_type7(group: str, value: str) -> str:
    return f"""SELECT {group}, CAST(count({value}) AS BIGINT) AS n,
      quantile_cont({value}, 0.25) AS q1, quantile_cont({value}, 0.5) AS median,
      quantile_cont({value}, 0.75) AS q3
    FROM src WHERE {value} IS NOT NULL AND {group} IS NOT NULL GROUP BY {group}"""


def _quartiles_type5(group: str, value: str) -> str:
    parts = []
    for name, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
        parts.append(f"""
      max(CASE WHEN rn = lo_{name} THEN {value} END)
        + (h_{name} - lo_{name}) * (max(CASE WHEN rn = hi_{name} THEN {value} END)
                                    - max(CASE WHEN rn = lo_{name} THEN {value} END)) AS {name}""")
    pos = []
    for name, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
        pos.append(f"least(greatest(n * {p} + 0.5, 1.0), n) AS h_{name}")
    pos2 = []
    for name, _ in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
        pos2.append(f"CAST(floor(h_{name}) AS BIGINT) AS lo_{name}, "
                    f"least(CAST(ceil(h_{name}) AS BIGINT), n) AS hi_{name}")
    return f"""SELECT {group}, n, {', '.join(parts)}
    FROM (
      SELECT *, {', '.join(pos2)} FROM (
        SELECT {group}, {value},
          row_number() OVER (PARTITION BY {group} ORDER BY {value}) AS rn,
          count(*) OVER (PARTITION BY {group}) AS n
        FROM src WHERE {value} IS NOT NULL AND {group} IS NOT NULL
      ) x, LATERAL (SELECT {', '.join(pos)})
    ) y
    GROUP BY {group}, n, h_q1, lo_q1, hi_q1, h_median, lo_median, hi_median, h_q3, lo_q3, hi_q3"""


ORACLE["box_stats"] = _box_sql("SELECT event_type, value FROM events", "event_type", "value",
                               _quartiles_type7("event_type", "value"))
ORACLE["box_stats_midpoint"] = _box_sql("SELECT event_type, value FROM events", "event_type", "value",
                                        _quartiles_type5("event_type", "value"))
ORACLE["box_stats_listings"] = _box_sql(f"{GOLD} SELECT city, price FROM gold WHERE {FILTERED}", "city", "price",
                                        _quartiles_type7("city", "price"))


def _hist_sql(source: str, value: str) -> str:
    return f"""
WITH src AS ({source}),
b AS (SELECT min({value}) AS lo, max({value}) AS hi FROM src),
x AS (
  SELECT CAST(CASE WHEN b.hi = b.lo THEN 0
              ELSE least(floor((s.{value} - b.lo) / ((b.hi - b.lo) / 20.0)), 19) END AS INTEGER) AS bin,
         b.lo, b.hi
  FROM src s, b WHERE s.{value} IS NOT NULL
)
SELECT bin, round(lo + bin * ((hi - lo) / 20.0), 6) AS bin_lo,
       round(lo + (bin + 1) * ((hi - lo) / 20.0), 6) AS bin_hi, CAST(count(*) AS BIGINT) AS n_rows
FROM x GROUP BY bin, lo, hi
"""


ORACLE["histogram_20"] = _hist_sql("SELECT value FROM events", "value")
ORACLE["histogram_listings"] = _hist_sql(f"{GOLD} SELECT price FROM gold WHERE city = 'ASIA' AND {FILTERED}", "price")

ORACLE["scatter_projection"] = f"""{GOLD}
SELECT area_m2, price, city, title, district, price_per_m2 FROM gold WHERE {FILTERED}
"""

ORACLE["lookup_projection"] = f"""{GOLD}
SELECT title, city, district, price, area_m2, num_bedrooms, url FROM gold
WHERE {FILTERED} AND num_bedrooms IN (1, 2, 3)
"""

ORACLE["partition_roundtrip"] = """
SELECT event_id, user_id, event_type, value, CAST(ts AS DATE) AS dt FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'
"""

ORACLE["partition_roundtrip_all"] = """
SELECT event_id, user_id, event_type, value, CAST(ts AS DATE) AS dt FROM events
"""

ORACLE["gold_upsert_incremental"] = GOLD_SQL

ORACLE["etl_gold"] = GOLD_SQL

ORACLE["etl_incremental"] = SILVER_SQL

ORACLE["etl_incremental_gold"] = GOLD_SQL

ORACLE["stream_ingest"] = SILVER_SQL

LINE = "CAST(regexp_extract(bedrooms_raw, '^[0-9]+') AS INTEGER)"
ORACLE["stream_dedupe"] = f"""
WITH silver AS ({SILVER_SQL}), a AS (
  SELECT *, row_number() OVER (PARTITION BY url ORDER BY CASE WHEN {LINE} > 5 THEN 1 WHEN {LINE} > 3 THEN 2 WHEN {LINE} > 1 THEN 3 ELSE 4 END,
    title NULLS FIRST, address NULLS FIRST, address_line_2 NULLS FIRST, description NULLS FIRST, crawled_at NULLS FIRST,
    price_raw NULLS FIRST, price_per_m2_raw NULLS FIRST, area_raw NULLS FIRST, bedrooms_raw NULLS FIRST) AS place FROM silver)
SELECT * EXCLUDE (place) FROM a WHERE place = 1
"""

ORACLE["stream_gold"] = GOLD_SQL

UNDATED = "CASE WHEN l_linenumber = 3 THEN NULL ELSE strftime(l_shipdate, '%Y-%m-01T') || lpad(CAST(l_linenumber AS VARCHAR), 2, '0') || ':00:00' END AS crawled_at_text"
DATED = "strftime(l_shipdate, '%Y-%m-%dT') || lpad(CAST(l_linenumber AS VARCHAR), 2, '0') || ':00:00' AS crawled_at_text"

ORACLE["etl_rerun"] = SILVER_SQL.replace(DATED, UNDATED)

ORACLE["etl_late_gold"] = GOLD_SQL.replace(DATED, UNDATED)

ORACLE["queue_log_state"] = ORACLE["update_status"]

ORACLE["queue_take_leased"] = f"""
WITH p AS (SELECT url, created_at, row_number() OVER (ORDER BY created_at ASC NULLS LAST, url) AS k
  FROM ({FRONTIER_SQL}) WHERE status = 'pending')
SELECT url, created_at, 'a' AS owner, TIMESTAMP '2026-01-01 01:00:00' AS until FROM p WHERE k BETWEEN 1 AND 10
UNION ALL SELECT url, created_at, 'b', TIMESTAMP '2026-01-01 01:30:00' FROM p WHERE k BETWEEN 11 AND 20
UNION ALL SELECT url, created_at, 'c', TIMESTAMP '2026-01-01 03:00:00' FROM p WHERE k BETWEEN 6 AND 15
"""

# The driver pages carry one <h1> and one <div class="ad"> without nested
# markup, so the tree parser's output is also expressible with regexes here.
ORACLE["extract_document"] = f"""
WITH t AS (
  SELECT page_id,
    regexp_replace(regexp_extract(html, '(?s)<h1(?:\\s[^>]*)?>(.*?)</h1>', 1), '<[^>]*>', '', 'g') AS raw_title,
    regexp_extract(html, '(?s)<div class="ad">(.*?)</div>', 1) AS raw_ad,
    {HREFS} AS hs
  FROM pages
)
SELECT page_id,
  regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(raw_title,
      '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&quot;?', '"', 'g'), '&#0*39;?', '''', 'g'), '&amp;?', '&', 'g'),
      '^\\s+|\\s+$', '', 'g') AS title,
  regexp_replace(raw_ad, '^\\s+|\\s+$', '', 'g') AS description,
  '{{}}' AS short_info,
  CAST(len(hs) AS INTEGER) AS n_links
FROM t
"""

# --- listing markup: stated from the columns that the pages are made of ---------

LISTING = """
SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority, c_mktsegment, n_name,
       CAST(o_orderkey AS VARCHAR) AS k
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
"""

ORACLE["extract_listing_document"] = f"""
SELECT {URL} || k AS url, 'Căn hộ ' || c_mktsegment || ' & ' || k AS title,
       'Số ' || k || ', ' || n_name AS address, 'Phường ' || n_name || ', B mới' AS address_line_2,
       'Mô tả ' || k || chr(10) || 'dòng hai' AS description, '2026-01-01T00:00:00.000000' AS crawled_at,
       printf('%.2f', o_totalprice) || ' <tỷ>' AS price,
       CASE WHEN o_orderstatus = 'F' THEN '~' || k || ' triệu/m²' END AS price_ext,
       CAST(CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 1 END AS INTEGER) AS n_short,
       c_mktsegment AS legal, CAST(1 AS INTEGER) AS n_specs
FROM ({LISTING}) WHERE o_orderpriority <> '4-NOT SPECIFIED'
"""

ORACLE["rejected_pages"] = f"""
SELECT o_orderkey AS page_id, {URL} || k AS url FROM ({LISTING}) WHERE o_orderpriority = '4-NOT SPECIFIED'
"""

ORACLE["extract_listing_links"] = f"""
SELECT o_orderkey AS page_id, CAST(0 AS INTEGER) AS pos, 'https://nha.example/p' || k || '?a=1&b=2' AS link FROM ({LISTING})
UNION ALL
SELECT o_orderkey, CAST(1 AS INTEGER), 'https://nha.example/up' || k FROM ({LISTING})
"""

ORACLE["extract_listing_links_parsed"] = f"""
SELECT o_orderkey AS page_id, CAST(0 AS INTEGER) AS pos, '/p' || k || '?a=1&b=2' AS href FROM ({LISTING})
UNION ALL
SELECT o_orderkey, CAST(1 AS INTEGER), '/up' || k FROM ({LISTING})
UNION ALL
SELECT o_orderkey, CAST(2 AS INTEGER), 'https://other.example/' || k FROM ({LISTING})
"""

ON_PAGE = "o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'"

ORACLE["link_round_frontier"] = f"""
WITH t AS ({FRONTIER_SQL} WHERE o_orderdate < TIMESTAMP '2000-01-01')
SELECT url, status FROM t
UNION ALL
SELECT {URL} || CAST(o_orderkey AS VARCHAR), 'pending' FROM orders
WHERE {ON_PAGE} AND NOT (o_orderdate < TIMESTAMP '2000-01-01')
"""

ORACLE["link_round_state"] = f"""
SELECT 'loc-' || CAST(c_custkey AS VARCHAR) AS location_name,
       CAST(CASE WHEN o.n IS NULL THEN 1 WHEN c_acctbal < 0 THEN 3 ELSE 2 END AS INTEGER) AS current_page
FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders WHERE {ON_PAGE} GROUP BY o_custkey) o
  ON o.o_custkey = c_custkey
"""

ORACLE["link_round_quarantine"] = f"""
SELECT c_custkey AS page_id,
       'https://nha.example/loc-' || CAST(c_custkey AS VARCHAR) || CASE WHEN c_acctbal < 0 THEN '/p2' ELSE '' END AS url,
       'loc-' || CAST(c_custkey AS VARCHAR) AS name, CAST(0 AS BIGINT) AS n_links
FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE {ON_PAGE} AND o_custkey IS NOT NULL)
"""

ORACLE["detail_round"] = f"""
WITH f AS ({FRONTIER_SQL}),
take AS (SELECT url FROM f WHERE status = 'pending' ORDER BY created_at ASC NULLS LAST, url ASC NULLS LAST LIMIT 1000),
landed AS (SELECT url FROM take SEMI JOIN
           (SELECT {URL} || k AS url FROM ({LISTING}) WHERE o_orderpriority <> '4-NOT SPECIFIED') USING (url))
SELECT f.url, CASE WHEN l.url IS NOT NULL THEN 'crawled' ELSE f.status END AS status, f.created_at
FROM f LEFT JOIN landed l ON l.url = f.url
"""
