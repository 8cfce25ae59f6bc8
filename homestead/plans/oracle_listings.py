"""DuckDB SQL for the listings flow (independent re-statement of the rules,
used only as a correctness oracle)."""

# Crawl rows in SQL: same derivation as plans/listings.py::listing_crawls.
LISTING_CRAWLS_SQL = r"""
  SELECT
    'https://nha.example/can-ho-' || CAST(o_orderkey AS VARCHAR) AS url,
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN ' '
         ELSE 'Căn hộ ' || c_mktsegment || ' ' || CAST(o_orderkey AS VARCHAR) END AS title,
    CASE WHEN o_orderstatus = 'O' THEN CAST(l_linenumber AS VARCHAR) || 'A, ' || n_name
         ELSE 'Số ' || CAST(l_linenumber AS VARCHAR) || ', ' || c_mktsegment || ', ' || n_name END AS address,
    CASE WHEN o_orderpriority = '1-URGENT' THEN d.district
         ELSE d.district || ', ' || r_name || CASE WHEN c_acctbal < 0 THEN ' cũ' ELSE ' mới' END
    END AS address_line_2,
    CASE WHEN l_returnflag = 'R' THEN 'Thỏa thuận'
         ELSE replace(printf('%.2f', o_totalprice), '.', ',') || ' tỷ' END AS price_raw,
    '~' || replace(printf('%.2f', l_extendedprice), '.', ',') || ' triệu/m²' AS price_per_m2_raw,
    replace(printf('%.1f', l_quantity), '.', ',') || ' m²' AS area_raw,
    CAST(l_linenumber AS VARCHAR) || ' PN' AS bedrooms_raw,
    CASE WHEN o_orderpriority = '2-HIGH' THEN strftime(o_orderdate, '%Y-%m-%d')
         ELSE strftime(o_orderdate, '%d/%m/%Y') END AS posted_date_str,
    strftime(l_shipdate, '%d/%m/%Y') AS expired_date_str,
    CAST(l_linenumber AS VARCHAR) || ' phòng' AS specs_bedrooms_raw,
    c_mktsegment AS house_direction,
    CASE WHEN l_returnflag = 'A' THEN 'Hợp đồng mua bán'
         WHEN l_linestatus = 'F' THEN 'Sổ đỏ/ Sổ hồng'
         ELSE 'Đang chờ' END AS legal_status,
    '' AS description,
    strftime(l_shipdate, '%Y-%m-%dT') || lpad(CAST(l_linenumber AS VARCHAR), 2, '0') || ':00:00' AS crawled_at_text
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey,
  LATERAL (SELECT CASE o_orderstatus WHEN 'F' THEN 'Phường ' || n_name
                                     WHEN 'O' THEN 'Quận ' || n_name
                                     ELSE 'Quận Xã ' || n_name END AS district) d
"""

SILVER_SQL = r"""
WITH crawls AS (""" + LISTING_CRAWLS_SQL + r"""),
typed AS (
  SELECT *, TRY_CAST(crawled_at_text AS TIMESTAMP) AS crawled_at,
         string_split(address_line_2, ',') AS a2
  FROM crawls
  WHERE title IS NOT NULL AND trim(title, ' ') <> ''
),
parts AS (
  SELECT *,
    regexp_replace(trim(a2[1], ' '), '^(Quận|Huyện|Thị xã)\s+', '') AS district,
    regexp_replace(trim(a2[2], ' '), '\s+(mới|cũ)$', '') AS city
  FROM typed WHERE len(a2) >= 2
)
SELECT url, title, address, address_line_2, description, crawled_at,
  price_raw, price_per_m2_raw, area_raw, bedrooms_raw, posted_date_str, expired_date_str,
  specs_bedrooms_raw, house_direction, legal_status, district, city,
  TRY_CAST(replace(regexp_replace(price_raw, '[^0-9,]', '', 'g'), ',', '.') AS DOUBLE) AS price,
  TRY_CAST(replace(regexp_replace(area_raw, '[^0-9,]', '', 'g'), ',', '.') AS DOUBLE) AS area_m2,
  TRY_CAST(replace(regexp_replace(price_per_m2_raw, '[^0-9,]', '', 'g'), ',', '.') AS DOUBLE) AS price_per_m2,
  CAST(try_strptime(posted_date_str, '%d/%m/%Y') AS DATE) AS posted_date,
  CAST(crawled_at AS DATE) AS dt
FROM parts
WHERE regexp_matches(district, '^(Xã|Phường)\s')
"""

GOLD_SQL = r"""
WITH silver AS (""" + SILVER_SQL + r"""),
latest AS (
  SELECT * FROM silver
  QUALIFY row_number() OVER (PARTITION BY url ORDER BY crawled_at DESC NULLS LAST,
     title ASC NULLS FIRST, address ASC NULLS FIRST, specs_bedrooms_raw ASC NULLS FIRST,
     house_direction ASC NULLS FIRST, legal_status ASC NULLS FIRST, district ASC NULLS FIRST,
     city ASC NULLS FIRST, price ASC NULLS FIRST, area_m2 ASC NULLS FIRST,
     price_per_m2 ASC NULLS FIRST, posted_date ASC NULLS FIRST, dt ASC NULLS FIRST) = 1
)
SELECT url,
  trim(list_filter(string_split(address, ','),
       lambda x: NOT (regexp_matches(trim(x, ' '), '^[0-9/\sA-Za-z]{1,6}$')
                 OR starts_with(lower(trim(x, ' ')), 'số')))[1], ' ') AS project_name,
  title, district, city, price, area_m2, price_per_m2,
  TRY_CAST(regexp_replace(specs_bedrooms_raw, '[^0-9]', '', 'g') AS INTEGER) AS num_bedrooms,
  house_direction,
  CASE WHEN contains(lower(legal_status), 'sổ') OR contains(lower(legal_status), 'đỏ')
         OR contains(lower(legal_status), 'hồng') THEN 1 ELSE 0 END AS has_legal_docs,
  posted_date, dt,
  TIMESTAMP '2026-01-01 02:00:00' AS gold_loaded_at
FROM latest
"""
