"""Independent DuckDB SQL for every registered query.

Written from the warehouse semantics directly (several aggregates joined back
on their keys, windows with explicit tie-breaks), not from the Spark plans, so
the two implementations check each other. Tables ``supplier nation part
orders lineitem`` are the registered test views.
"""

from __future__ import annotations

# --- binding: raw inputs ------------------------------------------------------

RAW = """
raw_poi AS (
  SELECT CAST(s.s_suppkey AS VARCHAR) AS poi_id, s.s_name AS name_zh, s.s_name AS name_en,
         n.n_name AS city_zh, n.n_name AS city_en,
         CAST(4 + (s.s_suppkey * 7) % 52 AS VARCHAR) AS latitude,
         CAST(73 + (s.s_suppkey * 11) % 64 AS VARCHAR) AS longitude,
         CASE WHEN p.p_type = 'PROMO' THEN NULL ELSE replace(p.p_name, ' ', ';') END AS label_zh,
         p.p_name AS label_en
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
                  JOIN part p ON p.p_partkey = s.s_suppkey),
seqs AS (
  SELECT l_orderkey, string_agg(CAST(l_suppkey AS VARCHAR), ';' ORDER BY l_linenumber, l_suppkey, l_partkey) AS seq
  FROM lineitem GROUP BY l_orderkey),
trip_base AS (
  SELECT o.o_orderkey AS k, CAST(o.o_custkey AS VARCHAR) AS blog_id,
         strftime(o.o_orderdate, '%Y/%-m/%-d') AS departure_date,
         CASE o.o_orderpriority WHEN '1-URGENT' THEN 'Solo' WHEN '4-NOT SPECIFIED' THEN NULL
              ELSE o.o_orderpriority END AS travel_partners,
         q.seq AS visit_sequence
  FROM orders o JOIN seqs q ON q.l_orderkey = o.o_orderkey),
raw_trip AS (
  SELECT blog_id, departure_date AS retrieval_date, departure_date, travel_partners, visit_sequence FROM trip_base),
dirty_base AS (
  SELECT k, blog_id,
         CASE WHEN k % 101 = 0 THEN NULL WHEN k % 97 = 0 THEN replace(departure_date, '/', '-')
              ELSE departure_date END AS departure_date,
         travel_partners,
         CASE WHEN k % 7 = 0 THEN visit_sequence || ';; ;' ELSE visit_sequence END AS visit_sequence
  FROM trip_base),
dirty_trip AS (
  SELECT blog_id, departure_date, travel_partners, visit_sequence FROM dirty_base
  UNION ALL
  SELECT blog_id, departure_date, 'Family' AS travel_partners, visit_sequence FROM dirty_base WHERE k % 10 = 0)"""

# --- POI cleaning -------------------------------------------------------------

POI = """
poi_prep AS (
  SELECT poi_id, name_zh, city_zh, TRY_CAST(latitude AS DOUBLE) AS latitude,
         TRY_CAST(longitude AS DOUBLE) AS longitude, coalesce(label_zh, '无标签') AS label_zh
  FROM raw_poi
  WHERE poi_id IS NOT NULL AND name_zh IS NOT NULL AND city_zh IS NOT NULL
    AND latitude IS NOT NULL AND longitude IS NOT NULL),
poi_box AS (
  SELECT * FROM poi_prep WHERE latitude >= 4 AND latitude <= 54 AND longitude >= 73 AND longitude <= 135),
poi_class AS (
  SELECT *, string_split(label_zh, ';') AS label,
    CASE WHEN latitude >= 40 AND longitude >= 120 THEN '东北'
         WHEN latitude >= 35 AND latitude < 40 AND longitude >= 110 AND longitude < 120 THEN '华北'
         WHEN latitude >= 35 AND longitude < 110 THEN '西北'
         WHEN latitude >= 28 AND latitude < 35 AND longitude >= 115 THEN '华东'
         WHEN latitude >= 28 AND latitude < 35 AND longitude >= 110 AND longitude < 115 THEN '华中'
         WHEN latitude <= 28 AND longitude >= 110 THEN '华南'
         ELSE '西南' END AS region,
    CASE WHEN regexp_matches(label_zh, 'ring|bolt') THEN 'fastener'
         WHEN regexp_matches(label_zh, 'gear|rod') THEN 'drive'
         WHEN label_zh = '无标签' THEN '未分类'
         ELSE '其他景点' END AS category
  FROM poi_box),
poi AS (
  SELECT poi_id, name_zh AS name, city_zh AS city, latitude, longitude, label, category, region
  FROM poi_class
  QUALIFY row_number() OVER (PARTITION BY poi_id ORDER BY name_zh, city_zh, latitude, longitude) = 1)"""

# --- visit cleaning (parameterised by source and years) -----------------------

def _visits(src: str, lo: int = 1995, hi: int = 2002) -> str:
    return f"""
trip_prep AS (
  SELECT blog_id, departure_date, coalesce(travel_partners, 'Unrecorded') AS travel_partners, visit_sequence,
         CASE WHEN regexp_full_match(departure_date, '[0-9]{{4}}/[0-9]{{1,2}}/[0-9]{{1,2}}')
              THEN CAST(try_strptime(departure_date, '%Y/%m/%d') AS DATE) END AS travel_date
  FROM {src}
  WHERE blog_id IS NOT NULL AND departure_date IS NOT NULL AND visit_sequence IS NOT NULL),
trip_dedup AS (
  SELECT blog_id, departure_date, visit_sequence, min(travel_partners) AS travel_partners,
         min(travel_date) AS travel_date
  FROM trip_prep GROUP BY blog_id, departure_date, visit_sequence),
trips AS (
  SELECT blog_id, blog_id || '_' || departure_date AS trip_id, travel_date,
         year(travel_date) AS travel_year, month(travel_date) AS travel_month, travel_partners, visit_sequence
  FROM trip_dedup WHERE year(travel_date) >= {lo} AND year(travel_date) < {hi}),
visit_items AS (
  SELECT blog_id, trip_id, travel_date, travel_year, travel_month, travel_partners,
         unnest(string_split(visit_sequence, ';')) AS item
  FROM trips),
visits AS (
  SELECT blog_id, trip_id, travel_date, travel_year, travel_month, travel_partners, trim(item) AS poi_id
  FROM visit_items WHERE trim(item) <> '')"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(p.strip("\n") for p in parts) + "\n"


VISITS = _visits("raw_trip")

# --- user quarter mart ----------------------------------------------------------

UQ = """
jl AS (
  SELECT v.*, quarter(v.travel_date) AS travel_quarter, p.city, p.category, p.region
  FROM visits v LEFT JOIN poi p ON v.poi_id = p.poi_id),
uq_base AS (
  SELECT blog_id, travel_year, travel_quarter,
         count(DISTINCT trip_id) AS trip_total_cnt, count(*) AS total_spot_cnt,
         count(DISTINCT city) AS unique_city_cnt,
         count(DISTINCT region) AS n_region,
         coalesce(array_to_string(list_sort(array_agg(DISTINCT region) FILTER (WHERE region IS NOT NULL)), ','), '') AS region_arr,
         coalesce(array_to_string(list_sort(array_agg(DISTINCT travel_partners)), ','), '') AS partner_arr,
         min(travel_date) AS first_trip_date, max(travel_date) AS last_trip_date
  FROM jl GROUP BY blog_id, travel_year, travel_quarter),
uq_trip_region AS (
  SELECT blog_id, travel_year, travel_quarter, trip_id, count(DISTINCT region) AS region_cnt
  FROM jl GROUP BY blog_id, travel_year, travel_quarter, trip_id),
uq_cross AS (
  SELECT blog_id, travel_year, travel_quarter, count(*) AS cross_region_trip_cnt
  FROM uq_trip_region WHERE region_cnt >= 2 GROUP BY blog_id, travel_year, travel_quarter),
uq_city_cnt AS (
  SELECT blog_id, travel_year, travel_quarter, city, count(DISTINCT trip_id) AS c,
         max(count(DISTINCT trip_id)) OVER (PARTITION BY blog_id, travel_year, travel_quarter) AS mx
  FROM jl WHERE city IS NOT NULL GROUP BY blog_id, travel_year, travel_quarter, city),
uq_city AS (
  SELECT blog_id, travel_year, travel_quarter,
         string_agg(city || ':' || CAST(c AS VARCHAR), ',' ORDER BY city) AS city_visit_map,
         string_agg(city, ',' ORDER BY city) FILTER (WHERE c = mx) AS top_city
  FROM uq_city_cnt GROUP BY blog_id, travel_year, travel_quarter),
uq_cate_cnt AS (
  SELECT blog_id, travel_year, travel_quarter, category, count(*) AS c,
         max(count(*)) OVER (PARTITION BY blog_id, travel_year, travel_quarter) AS mx
  FROM jl WHERE category <> '未分类' GROUP BY blog_id, travel_year, travel_quarter, category),
uq_cate AS (
  SELECT blog_id, travel_year, travel_quarter, count(*) AS unique_category_cnt,
         string_agg(category || ':' || CAST(c AS VARCHAR), ',' ORDER BY category) AS cate_visit_map,
         string_agg(category, ',' ORDER BY category) FILTER (WHERE c = mx) AS top_category
  FROM uq_cate_cnt GROUP BY blog_id, travel_year, travel_quarter),
uq_trip_partner AS (
  SELECT blog_id, travel_year, travel_quarter, trip_id, min(travel_partners) AS partner
  FROM jl GROUP BY blog_id, travel_year, travel_quarter, trip_id),
uq_solo AS (
  SELECT blog_id, travel_year, travel_quarter, count(*) AS solo_trip_cnt
  FROM uq_trip_partner WHERE partner = 'Solo' GROUP BY blog_id, travel_year, travel_quarter),
uq_month AS (
  SELECT blog_id, travel_year, travel_quarter, travel_month, count(*) AS m
  FROM jl GROUP BY blog_id, travel_year, travel_quarter, travel_month),
uq_peak AS (
  SELECT blog_id, travel_year, travel_quarter, travel_month AS peak_month FROM uq_month
  QUALIFY row_number() OVER (PARTITION BY blog_id, travel_year, travel_quarter ORDER BY m DESC, travel_month) = 1),
uq AS (
  SELECT b.blog_id,
         CASE WHEN b.trip_total_cnt >= 4 THEN '高频' WHEN b.trip_total_cnt IN (2, 3) THEN '中频' ELSE '低频' END AS travel_level,
         CASE WHEN b.n_region >= 2 THEN '全国型'
              WHEN b.n_region = 1 AND b.unique_city_cnt >= 2 THEN '区域型'
              WHEN b.unique_city_cnt = 1 THEN '单城型' END AS region_type,
         b.trip_total_cnt, b.total_spot_cnt, b.unique_city_cnt,
         coalesce(ca.unique_category_cnt, 0) AS unique_category_cnt,
         coalesce(x.cross_region_trip_cnt, 0) AS cross_region_trip_cnt,
         round(b.total_spot_cnt / b.trip_total_cnt, 4) AS avg_spot_per_trip,
         round(b.unique_city_cnt / b.trip_total_cnt, 4) AS avg_city_per_trip,
         round(b.trip_total_cnt / 3, 4) AS avg_trip_per_month,
         b.region_arr, b.partner_arr,
         coalesce(ci.top_city, '') AS top_city, ca.top_category,
         round(coalesce(s.solo_trip_cnt, 0) / b.trip_total_cnt, 4) AS solo_trip_ratio,
         coalesce(ci.city_visit_map, '') AS city_visit_map, ca.cate_visit_map,
         CAST(pk.peak_month AS BIGINT) AS peak_month, b.first_trip_date, b.last_trip_date,
         CAST(b.travel_year AS BIGINT) AS travel_year, CAST(b.travel_quarter AS BIGINT) AS travel_quarter
  FROM uq_base b
  LEFT JOIN uq_cross x USING (blog_id, travel_year, travel_quarter)
  LEFT JOIN uq_city ci USING (blog_id, travel_year, travel_quarter)
  LEFT JOIN uq_cate ca USING (blog_id, travel_year, travel_quarter)
  LEFT JOIN uq_solo s USING (blog_id, travel_year, travel_quarter)
  LEFT JOIN uq_peak pk USING (blog_id, travel_year, travel_quarter))"""

# --- attraction mart ------------------------------------------------------------

AQ = """
ji AS (
  SELECT v.*, quarter(v.travel_date) AS travel_quarter, p.name, p.city, p.category, p.region
  FROM visits v JOIN poi p ON v.poi_id = p.poi_id),
aq_agg AS (
  SELECT poi_id, name, city, category, region, travel_year, travel_quarter,
         count(DISTINCT blog_id) AS visit_user_cnt, count(DISTINCT trip_id) AS visit_trip_cnt,
         count(*) AS visit_total_cnt,
         sum(CASE WHEN travel_partners = 'Solo' THEN 1 ELSE 0 END) AS solo_trip_cnt
  FROM ji GROUP BY poi_id, name, city, category, region, travel_year, travel_quarter),
aq_prev AS (
  SELECT *, lag(visit_user_cnt) OVER (PARTITION BY poi_id ORDER BY travel_year, travel_quarter) AS prev
  FROM aq_agg),
aq AS (
  SELECT poi_id, name, city, category, region, visit_user_cnt, visit_trip_cnt, visit_total_cnt,
         row_number() OVER (PARTITION BY city, travel_year, travel_quarter ORDER BY visit_trip_cnt DESC, poi_id) AS user_rank_in_city,
         row_number() OVER (PARTITION BY region, travel_year, travel_quarter ORDER BY visit_trip_cnt DESC, poi_id) AS user_rank_in_region,
         row_number() OVER (PARTITION BY travel_year, travel_quarter ORDER BY visit_trip_cnt DESC, poi_id) AS user_rank_overall,
         round(solo_trip_cnt / visit_trip_cnt, 4) AS solo_user_ratio,
         CASE WHEN prev > 0 THEN round((visit_user_cnt - prev) / prev, 4) ELSE 0.0 END AS user_cnt_growth_rate,
         CASE WHEN prev IS NULL THEN '无上期数据'
              WHEN prev > 0 AND round((visit_user_cnt - prev) / prev, 4) > 0.3 THEN '是' ELSE '否' END AS is_hot_rising,
         CAST(travel_year AS BIGINT) AS travel_year, CAST(travel_quarter AS BIGINT) AS travel_quarter
  FROM aq_prev)"""

# --- city mart --------------------------------------------------------------------

CQ = """
jc AS (
  SELECT v.*, quarter(v.travel_date) AS travel_quarter, p.city, p.region
  FROM visits v JOIN poi p ON v.poi_id = p.poi_id),
cq_agg AS (
  SELECT city, region, travel_year, travel_quarter,
         count(DISTINCT blog_id) AS visit_user_cnt, count(trip_id) AS visit_trip_cnt,
         count(*) AS visit_spot_cnt, count(DISTINCT poi_id) AS unique_attraction_cnt,
         sum(CASE WHEN travel_partners = 'Solo' THEN 1 ELSE 0 END) AS solo_trip_cnt
  FROM jc GROUP BY city, region, travel_year, travel_quarter),
cq_prev AS (
  SELECT *, lag(visit_trip_cnt) OVER (PARTITION BY city, region ORDER BY travel_year, travel_quarter) AS prev
  FROM cq_agg),
cq AS (
  SELECT city, region, visit_user_cnt, visit_trip_cnt, visit_spot_cnt, unique_attraction_cnt,
         CAST(floor(visit_spot_cnt / visit_user_cnt) AS BIGINT) AS avg_spot_per_user,
         round(solo_trip_cnt / visit_trip_cnt, 4) AS solo_user_ratio,
         row_number() OVER (PARTITION BY travel_year, travel_quarter, region ORDER BY visit_trip_cnt DESC, city, region) AS user_rank_in_region,
         row_number() OVER (PARTITION BY travel_year, travel_quarter ORDER BY visit_trip_cnt DESC, city, region) AS user_rank_overall,
         CASE WHEN prev > 0 THEN round((visit_trip_cnt - prev) / prev, 4) ELSE 0.0 END AS user_cnt_growth_rate,
         CASE WHEN prev IS NULL THEN '无上期数据'
              WHEN prev > 0 AND round((visit_trip_cnt - prev) / prev, 4) > 0.3 THEN '是' ELSE '否' END AS is_hot_rising,
         CAST(travel_year AS BIGINT) AS travel_year, CAST(travel_quarter AS BIGINT) AS travel_quarter
  FROM cq_prev)"""

# --- portrait (reads the user quarter mart's numeric parts again from jl) ---------

PORTRAIT = """
pq AS (
  SELECT b.blog_id, b.travel_year, b.trip_total_cnt, b.total_spot_cnt,
         CAST(round(round(b.total_spot_cnt / b.trip_total_cnt, 4) * 10000) AS BIGINT) AS spt4,
         CAST(round(round(coalesce(s.solo_trip_cnt, 0) / b.trip_total_cnt, 4) * 10000) AS BIGINT) AS solo4
  FROM uq_base b LEFT JOIN uq_solo s USING (blog_id, travel_year, travel_quarter)),
pt_user AS (
  SELECT blog_id, sum(trip_total_cnt) AS total_trips, sum(total_spot_cnt) AS total_spots,
         count(DISTINCT travel_year) AS active_years, min(travel_year) AS first_active_year,
         max(travel_year) AS last_active_year, sum(spt4) AS s_spt, sum(solo4) AS s_solo, count(*) AS nq
  FROM pq GROUP BY blog_id),
pt_city_sum AS (
  SELECT blog_id, city, sum(c) AS total_cnt FROM uq_city_cnt GROUP BY blog_id, city),
pt_city AS (
  SELECT blog_id, count(*) AS total_cities,
         string_agg(city, ',' ORDER BY city) FILTER (WHERE rk = 1) AS favorite_city
  FROM (SELECT *, dense_rank() OVER (PARTITION BY blog_id ORDER BY total_cnt DESC) AS rk FROM pt_city_sum)
  GROUP BY blog_id),
pt_cate_sum AS (
  SELECT blog_id, category, sum(c) AS total_cnt FROM uq_cate_cnt GROUP BY blog_id, category),
pt_cate AS (
  SELECT blog_id, string_agg(category, ',' ORDER BY category) FILTER (WHERE rk = 1) AS favorite_category
  FROM (SELECT *, dense_rank() OVER (PARTITION BY blog_id ORDER BY total_cnt DESC) AS rk FROM pt_cate_sum)
  GROUP BY blog_id),
pt_region AS (
  SELECT blog_id, count(DISTINCT region) AS total_regions FROM jl WHERE region IS NOT NULL GROUP BY blog_id),
portrait AS (
  SELECT u.blog_id, CAST(u.total_trips AS BIGINT) AS total_trips, CAST(u.total_spots AS BIGINT) AS total_spots,
         c.total_cities, r.total_regions, u.active_years,
         CAST(u.first_active_year AS BIGINT) AS first_active_year,
         CAST(u.last_active_year AS BIGINT) AS last_active_year,
         ((u.s_spt * 2 + u.nq * 100) // (u.nq * 200)) / 100.0 AS avg_spots_per_trip,
         ((u.s_solo * 2 + u.nq * 100) // (u.nq * 200)) / 100.0 AS solo_trip_ratio,
         c.favorite_city, k.favorite_category,
         CASE WHEN u.total_trips / u.active_years >= 2 THEN '高频'
              WHEN u.total_trips / u.active_years >= 1 THEN '中频' ELSE '低频' END AS travel_level,
         CASE WHEN r.total_regions >= 2 THEN '全国型' WHEN c.total_cities >= 2 THEN '区域型'
              ELSE '单城型' END AS region_type
  FROM pt_user u LEFT JOIN pt_city c USING (blog_id) LEFT JOIN pt_cate k USING (blog_id)
                 LEFT JOIN pt_region r USING (blog_id))"""


def _uq_select(*cols: str) -> str:
    return _with(RAW, POI, VISITS, UQ) + f"SELECT blog_id, travel_year, travel_quarter, {', '.join(cols)} FROM uq"


def _aq_select(*cols: str) -> str:
    return _with(RAW, POI, VISITS, AQ) + f"SELECT poi_id, travel_year, travel_quarter, {', '.join(cols)} FROM aq"


def _cq_select(*cols: str) -> str:
    return _with(RAW, POI, VISITS, CQ) + f"SELECT city, region, travel_year, travel_quarter, {', '.join(cols)} FROM cq"


def _pt_select(*cols: str) -> str:
    return _with(RAW, POI, VISITS, UQ, PORTRAIT) + f"SELECT blog_id, {', '.join(cols)} FROM portrait"


# --- inputs of the paths that other callers get -----------------------------------

DIRTY_POI = """
raw_poi AS (
  SELECT CASE WHEN p_partkey % 53 <> 0 THEN CAST(p_partkey % 1500 AS VARCHAR) END AS poi_id,
         CASE WHEN p_partkey % 59 <> 0 THEN 'n' || p_partkey END AS name_zh,
         CASE WHEN p_partkey % 61 <> 0 THEN 'c' || (p_partkey % 40) END AS city_zh,
         CASE WHEN p_partkey % 67 = 0 THEN NULL WHEN p_partkey % 31 = 0 THEN 'x12'
              ELSE CAST(1 + (p_partkey * 7) % 56 AS VARCHAR) END AS latitude,
         CASE WHEN p_partkey % 71 <> 0 THEN CAST(70 + (p_partkey * 11) % 68 AS VARCHAR) END AS longitude,
         CASE p_partkey % 9 WHEN 0 THEN '峡谷漂流' WHEN 1 THEN '名人故居' WHEN 2 THEN '古镇' WHEN 3 THEN '高楼' WHEN 4 THEN '步行街;商圈'
              WHEN 5 THEN '农庄' WHEN 6 THEN '湖泊' WHEN 7 THEN '写字楼' END AS label_zh
  FROM part)"""
# What each of those labels is by the seven shipped rules, the first that fits: 漂流 goes before 峡谷.
DIRTY_CATEGORY = """
dirty_class AS (
  SELECT poi_id, name_zh AS name, city_zh AS city, latitude, longitude, label, region,
         CASE label_zh WHEN '峡谷漂流' THEN '主题游乐' WHEN '名人故居' THEN '文化场馆' WHEN '古镇' THEN '历史人文古迹' WHEN '高楼' THEN '都市地标'
              WHEN '步行街;商圈' THEN '都市休闲' WHEN '农庄' THEN '乡村生态' WHEN '湖泊' THEN '自然风光' WHEN '无标签' THEN '未分类'
              ELSE '其他景点' END AS category
  FROM poi_class)"""
DIRTY_COLUMNS = "poi_id, name, city, latitude, longitude, array_to_string(list_sort(label), ',') AS label, category, region"
GAPPY_TRIP = """
gappy_trip AS (
  SELECT CASE WHEN o.o_orderkey % 89 <> 0 THEN CAST(o.o_custkey AS VARCHAR) END AS blog_id,
         strftime(o.o_orderdate, '%Y/%-m/%-d') AS departure_date, 'Solo' AS travel_partners, q.seq AS visit_sequence
  FROM orders o LEFT JOIN seqs q ON q.l_orderkey = o.o_orderkey)"""
STRICT = """
strict_prev AS (
  SELECT *, CASE WHEN travel_year * 4 + travel_quarter - lag(travel_year * 4 + travel_quarter) OVER w = 1
                 THEN lag(visit_user_cnt) OVER w END AS before
  FROM aq_agg WINDOW w AS (PARTITION BY poi_id ORDER BY travel_year, travel_quarter))"""


VISIT_COLS = ("blog_id, trip_id, travel_date, CAST(travel_year AS BIGINT) AS travel_year, "
              "CAST(travel_month AS BIGINT) AS travel_month, travel_partners, poi_id")


MESSY = """
messy AS (
  SELECT *, CASE WHEN k % 11 <> 0 AND k % 13 <> 0 AND k % 17 = 0 THEN '"' ELSE '' END || coalesce(travel_partners, '') AS partner FROM trip_base),
messy_lines AS (
  SELECT *, CASE WHEN k % 2 = 0 THEN [blog_id, departure_date, departure_date, partner, visit_sequence]
                 ELSE [visit_sequence, partner, departure_date, departure_date, blog_id] END AS f FROM messy)"""

# --- two loads: the second brings the same trips, so the late copies' partner is the smaller of both ----------

TWO_LOADS = """
two_loads AS (
  SELECT blog_id, departure_date, travel_partners, visit_sequence FROM trip_base
  UNION ALL
  SELECT blog_id, departure_date, 'zz', visit_sequence FROM trip_base
  WHERE k % 30 = 0 AND departure_date SIMILAR TO '1997/[456]/.*')"""
LOADED = _visits("two_loads")
SKEWED = VISITS.replace("visits AS (", "even_visits AS (") + """,
visits AS (
  SELECT * EXCLUDE (n) REPLACE (CASE WHEN n % 3 = 0 THEN '1' WHEN n % 17 <> 0 THEN poi_id END AS poi_id)
  FROM (SELECT *, length(trip_id) + length(poi_id) + travel_month AS n FROM even_visits))"""


def oracle_sql() -> dict[str, str]:
    dirty_visits = _visits("dirty_trip")
    skewed_join = (f"SELECT v.poi_id, {VISIT_COLS.replace(', poi_id', '').replace('blog_id', 'v.blog_id', 1)}, "
                   "p.name, p.city, p.category, p.region FROM visits v {} JOIN poi p ON v.poi_id = p.poi_id")
    return {
        "attraction_counts_bitmaps": _aq_select("visit_user_cnt", "visit_trip_cnt", "visit_total_cnt"),
        "city_counts_bitmaps": _cq_select("visit_user_cnt", "visit_trip_cnt", "visit_spot_cnt", "unique_attraction_cnt"),
        "attraction_year_bitmaps": _with(RAW, VISITS) + (
            "SELECT poi_id, CAST(travel_year AS BIGINT) AS travel_year, count(DISTINCT blog_id) AS visit_user_cnt, "
            "count(DISTINCT trip_id) AS visit_trip_cnt, count(*) AS visit_total_cnt FROM visits GROUP BY poi_id, travel_year"),
        "skewed_left_poi_split": _with(RAW, POI, SKEWED) + skewed_join.format("LEFT"),
        "skewed_inner_poi_split": _with(RAW, POI, SKEWED) + skewed_join.format(""),
        "user_quarter_split": _with(RAW, POI, SKEWED, UQ) + "SELECT * FROM uq",
        "raw_mixed_headers": _with(RAW, MESSY) + (
            "SELECT blog_id, departure_date AS retrieval_date, departure_date, travel_partners, visit_sequence FROM messy "
            "WHERE k % 11 <> 0 AND k % 13 <> 0 AND k % 17 <> 0"),
        "raw_rejects": _with(RAW, MESSY) + (
            "SELECT CASE WHEN k % 11 = 0 THEN 'short' WHEN k % 13 = 0 THEN 'long' ELSE 'quote' END AS reason, "
            "array_to_string(CASE WHEN k % 11 = 0 THEN f[1:4] WHEN k % 13 = 0 THEN list_append(f, 'surplus') ELSE f END, ',') AS line "
            "FROM messy_lines WHERE k % 11 = 0 OR k % 13 = 0 OR k % 17 = 0"),
        "read_after_failed_write": _with(RAW) + "SELECT * FROM raw_trip",
        "user_quarter_bucketed": _with(RAW, POI, VISITS, UQ) + "SELECT * FROM uq",
        "user_portrait_bucketed": _with(RAW, POI, VISITS, UQ, PORTRAIT) + "SELECT * FROM portrait",
        "poi_category_words": _with(RAW, POI) + "SELECT poi_id, label_zh, category FROM poi_class",
        "poi_category_words_dirty": _with(DIRTY_POI, POI, DIRTY_CATEGORY) + "SELECT poi_id, array_to_string(label, ';') AS label_zh, category FROM dirty_class",
        "profile_labels_summary": _with(RAW, POI) + (
            "SELECT label_zh, count(*) AS count FROM poi_box GROUP BY label_zh "
            "ORDER BY count DESC, label_zh LIMIT 50"),
        "top_places_summary": _with(RAW, POI, SKEWED) + (
            "SELECT poi_id, count(*) AS count FROM visits GROUP BY poi_id "
            "ORDER BY count DESC, poi_id NULLS FIRST LIMIT 50"),
        "refresh_visits": _with(RAW, TWO_LOADS, LOADED) + f"SELECT {VISIT_COLS} FROM visits",
        "refresh_user_quarter": _with(RAW, TWO_LOADS, POI, LOADED, UQ) + "SELECT * FROM uq",
        "refresh_attraction_quarter": _with(RAW, TWO_LOADS, POI, LOADED, AQ) + "SELECT * FROM aq",
        "refresh_city_quarter": _with(RAW, TWO_LOADS, POI, LOADED, CQ) + "SELECT * FROM cq",
        "refresh_user_portrait": _with(RAW, TWO_LOADS, POI, LOADED, UQ, PORTRAIT) + "SELECT * FROM portrait",
        "poi_clean_dirty": _with(DIRTY_POI, POI, DIRTY_CATEGORY) + (
            f"SELECT {DIRTY_COLUMNS} FROM dirty_class "
            "QUALIFY row_number() OVER (PARTITION BY poi_id ORDER BY name, city, latitude, longitude) = 1"),
        "poi_rows_dirty": _with(DIRTY_POI, POI, DIRTY_CATEGORY) + f"SELECT {DIRTY_COLUMNS} FROM dirty_class",
        "reject_null_region_open": _with(RAW, POI) + (
            "SELECT poi_id, name_zh, latitude, longitude FROM poi_class WHERE region = '西南'"),
        "visits_clean_gappy": _with(RAW, GAPPY_TRIP, _visits("gappy_trip")) + f"SELECT {VISIT_COLS} FROM visits",
        "attraction_ranks_range": _aq_select("user_rank_in_city", "user_rank_in_region", "user_rank_overall"),
        "attraction_growth_strict": _with(RAW, POI, VISITS, AQ, STRICT) + (
            "SELECT poi_id, CAST(travel_year AS BIGINT) AS travel_year, CAST(travel_quarter AS BIGINT) AS travel_quarter, "
            "CASE WHEN before > 0 THEN round((visit_user_cnt - before) / before, 4) ELSE 0.0 END AS user_cnt_growth_rate, "
            "CASE WHEN before IS NULL THEN '无上期数据' "
            "WHEN before > 0 AND round((visit_user_cnt - before) / before, 4) > 0.3 THEN '是' ELSE '否' END AS is_hot_rising "
            "FROM strict_prev"),
        "top50_recomputed": _with(RAW, POI, VISITS, AQ) + (
            "SELECT CAST(travel_year AS VARCHAR) || 'Q' || CAST(travel_quarter AS VARCHAR) AS year_quarter, "
            "poi_id, name, city, category, region, visit_user_cnt, visit_trip_cnt, "
            "user_rank_overall AS rank, is_hot_rising, user_cnt_growth_rate FROM aq WHERE user_rank_overall <= 50"),
        "user_quarter_shuffled": _with(RAW, POI, VISITS, UQ) + "SELECT * FROM uq",
        "raw_rename": _with(RAW) + "SELECT * FROM raw_poi",
        "raw_rename_trip": _with(RAW) + "SELECT * FROM raw_trip",
        "poi_clean": _with(RAW, POI) + (
            "SELECT poi_id, name, city, latitude, longitude, array_to_string(list_sort(label), ',') AS label, "
            "category, region FROM poi"),
        "poi_bbox": _with(RAW, POI) + "SELECT poi_id, latitude, longitude FROM poi_box",
        "poi_region": _with(RAW, POI) + "SELECT poi_id, latitude, longitude, region FROM poi_class",
        "poi_category": _with(RAW, POI) + "SELECT poi_id, label_zh, category FROM poi_class",
        "reject_null_region": _with(RAW, POI) + (
            "SELECT poi_id, name_zh, latitude, longitude FROM poi_class WHERE region IS NULL"),
        "profile_bounds": _with(RAW, POI) + (
            "SELECT min(latitude) AS min_latitude, max(latitude) AS max_latitude, "
            "min(longitude) AS min_longitude, max(longitude) AS max_longitude FROM poi_box"),
        "profile_labels": _with(RAW, POI) + (
            "SELECT label_zh, count(*) AS count FROM poi_box GROUP BY label_zh "
            "ORDER BY count DESC, label_zh LIMIT 50"),
        "profile_category": _with(RAW, POI) + "SELECT category, count(*) AS count FROM poi GROUP BY category",
        "profile_region": _with(RAW, POI) + "SELECT region, count(*) AS count FROM poi GROUP BY region",
        "profile_years": _with(RAW, VISITS) + (
            "SELECT CAST(year(travel_date) AS BIGINT) AS travel_year, count(*) AS count "
            "FROM trip_dedup GROUP BY 1"),
        "visits_dropna": _with(RAW) + (
            "SELECT blog_id, departure_date, travel_partners, visit_sequence FROM dirty_trip "
            "WHERE blog_id IS NOT NULL AND departure_date IS NOT NULL AND visit_sequence IS NOT NULL"),
        "partner_fill": _with(RAW) + (
            "SELECT blog_id, departure_date, coalesce(travel_partners, 'Unrecorded') AS travel_partners FROM raw_trip"),
        "reject_bad_dates": _with(RAW, dirty_visits) + "SELECT departure_date FROM trip_prep WHERE travel_date IS NULL",
        "visits_dedup": _with(RAW, dirty_visits) + (
            "SELECT blog_id, departure_date, visit_sequence, travel_partners, "
            "blog_id || '_' || departure_date AS trip_id, travel_date FROM trip_dedup"),
        "visits_year_range": _with(RAW, _visits("raw_trip", 1997, 2000)) + (
            "SELECT blog_id, trip_id, travel_date, CAST(travel_year AS BIGINT) AS travel_year, "
            "CAST(travel_month AS BIGINT) AS travel_month, travel_partners FROM trips"),
        "visits_exploded": _with(RAW, dirty_visits) + f"SELECT {VISIT_COLS} FROM visits",
        "visits_clean": _with(RAW, VISITS) + f"SELECT {VISIT_COLS} FROM visits",
        "visits_left_poi": _with(RAW, POI, VISITS) + (
            f"SELECT v.poi_id, {VISIT_COLS.replace(', poi_id', '').replace('blog_id', 'v.blog_id', 1)}, "
            "p.name, p.city, p.category, p.region FROM visits v LEFT JOIN poi p ON v.poi_id = p.poi_id"),
        "visits_inner_poi": _with(RAW, POI, VISITS) + (
            f"SELECT v.poi_id, {VISIT_COLS.replace(', poi_id', '').replace('blog_id', 'v.blog_id', 1)}, "
            "p.name, p.city, p.category, p.region FROM visits v JOIN poi p ON v.poi_id = p.poi_id"),
        "user_quarter_counts": _uq_select("trip_total_cnt", "total_spot_cnt", "unique_city_cnt", "unique_category_cnt"),
        "user_quarter_category": _uq_select("unique_category_cnt"),
        "user_quarter_cross_region": _uq_select("cross_region_trip_cnt"),
        "user_quarter_solo": _uq_select("solo_trip_ratio"),
        "user_quarter_dates": _uq_select("first_trip_date", "last_trip_date"),
        "user_quarter_sets": _uq_select("region_arr", "partner_arr"),
        "city_visit_map": _uq_select("city_visit_map"),
        "category_visit_map": _uq_select("cate_visit_map"),
        "top_city": _uq_select("top_city"),
        "top_category": _uq_select("top_category"),
        "peak_month": _uq_select("peak_month"),
        "user_quarter_ratios": _uq_select("avg_spot_per_trip", "avg_city_per_trip", "avg_trip_per_month"),
        "user_quarter_levels": _uq_select("travel_level", "region_type"),
        "user_quarter": _with(RAW, POI, VISITS, UQ) + "SELECT * FROM uq",
        "attraction_quarter_counts": _aq_select("visit_user_cnt", "visit_trip_cnt", "visit_total_cnt"),
        "attraction_solo": _aq_select("solo_user_ratio"),
        "attraction_ranks": _aq_select("user_rank_in_city", "user_rank_in_region", "user_rank_overall"),
        "attraction_growth": _aq_select("user_cnt_growth_rate", "is_hot_rising"),
        "attraction_quarter": _with(RAW, POI, VISITS, AQ) + "SELECT * FROM aq",
        "top50_attractions": _with(RAW, POI, VISITS, AQ) + (
            "SELECT CAST(travel_year AS VARCHAR) || 'Q' || CAST(travel_quarter AS VARCHAR) AS year_quarter, "
            "poi_id, name, city, category, region, visit_user_cnt, visit_trip_cnt, "
            "user_rank_overall AS rank, is_hot_rising, user_cnt_growth_rate "
            "FROM aq WHERE user_rank_overall <= 50 ORDER BY year_quarter, rank"),
        "city_quarter_counts": _cq_select("visit_user_cnt", "visit_trip_cnt", "visit_spot_cnt", "unique_attraction_cnt"),
        "city_quarter_features": _cq_select("avg_spot_per_user"),
        "city_solo": _cq_select("solo_user_ratio"),
        "city_ranks": _cq_select("user_rank_in_region", "user_rank_overall"),
        "city_growth": _cq_select("user_cnt_growth_rate", "is_hot_rising"),
        "city_quarter": _with(RAW, POI, VISITS, CQ) + "SELECT * FROM cq",
        "city_top10": _with(RAW, POI, VISITS, CQ) + (
            "SELECT CAST(travel_year AS VARCHAR) || 'Q' || CAST(travel_quarter AS VARCHAR) AS year_quarter, "
            "city, region, visit_user_cnt, visit_trip_cnt, unique_attraction_cnt, avg_spot_per_user, "
            "user_rank_overall AS rank, is_hot_rising FROM cq WHERE user_rank_overall <= 10 "
            "ORDER BY year_quarter, rank"),
        "portrait_totals": _pt_select("total_trips", "total_spots", "active_years", "first_active_year",
                                      "last_active_year"),
        "portrait_averages": _pt_select("avg_spots_per_trip", "solo_trip_ratio"),
        "portrait_reach": _pt_select("total_cities", "total_regions"),
        "favorite_city": _pt_select("favorite_city"),
        "favorite_category": _pt_select("favorite_category"),
        "portrait_levels": _pt_select("travel_level", "region_type"),
        "user_portrait": _with(RAW, POI, VISITS, UQ, PORTRAIT) + "SELECT * FROM portrait",
    }
