"""The SQL each catalog query must match, over the same star-schema tables."""

from __future__ import annotations

# Written out here rather than imported, so that a wrong value in the code under test shows.
CATEGORY_BASE = 2053013555631882655
ANCHOR = "2024-06-01 12:00:00"
RANGE = ("2024-01-05", "2024-01-14")
SEGMENT_NAMES = ("高价值客户", "潜力客户", "一般保持", "流失风险")
HIGH_VALUE = "高价值客户"

# --- shared views, written as common table expressions -----------------------------------

PRODUCT_COLUMNS = f"""p.p_partkey AS product_id,
    CAST({CATEGORY_BASE} + p.p_size AS BIGINT) AS category_id, p.p_type AS category_code,
    CASE WHEN p.p_partkey % 7 = 0 THEN 'unknown' ELSE p.p_brand END AS brand"""

EVENT_KEY = "CAST(regexp_extract(e.props, '[0-9]+') AS BIGINT)"

BEHAVIOR = f"""behavior AS (
  SELECT e.ts AS event_time,
    CASE e.event_type WHEN 'click' THEN 'cart' ELSE e.event_type END AS event_type,
    {PRODUCT_COLUMNS}, CAST(e.value AS DECIMAL(10,2)) AS price, e.user_id,
    CAST(e.user_id AS VARCHAR) || '-' || CAST(CAST(e.ts AS DATE) AS VARCHAR) AS session_id,
    CAST(e.ts AS DATE) AS event_date
  FROM events e JOIN part p ON {EVENT_KEY} = p.p_partkey
  WHERE e.event_type IN ('view', 'click', 'purchase'))"""

BEHAVIOR_LI = f"""behavior AS (
  SELECT o.o_orderdate AS event_time,
    CASE l.l_returnflag WHEN 'N' THEN 'view' WHEN 'A' THEN 'cart' ELSE 'purchase' END
      AS event_type,
    {PRODUCT_COLUMNS}, CAST(l.l_extendedprice AS DECIMAL(10,2)) AS price,
    o.o_custkey AS user_id,
    CAST(o.o_custkey AS VARCHAR) || '-' || CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR)
      AS session_id,
    CAST(o.o_orderdate AS DATE) AS event_date
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey)"""

RAW = f"""raw AS (
  SELECT strftime(e.ts, '%Y-%m-%d %H:%M:%S') || ' UTC' AS event_time,
    CASE e.event_type WHEN 'click' THEN 'cart' ELSE e.event_type END AS event_type,
    CAST(p.p_partkey AS VARCHAR) AS product_id,
    CAST({CATEGORY_BASE} + p.p_size AS VARCHAR) AS category_id, p.p_type AS category_code,
    CASE WHEN p.p_partkey % 7 = 0 THEN '' ELSE p.p_brand END AS brand,
    CASE e.event_type WHEN 'error' THEN '' ELSE CAST(CAST(e.value AS DECIMAL(10,2)) AS VARCHAR)
      END AS price,
    CASE e.event_type WHEN 'error' THEN 'n/a' ELSE CAST(e.user_id AS VARCHAR) END AS user_id,
    CAST(e.user_id AS VARCHAR) || '-' || CAST(CAST(e.ts AS DATE) AS VARCHAR) AS user_session,
    date_trunc('second', e.ts) AS parsed_time, e.event_id % 97 AS dirt
  FROM events e JOIN part p ON {EVENT_KEY} = p.p_partkey)"""

LINE = ("concat_ws(',', event_time, event_type, product_id, category_id, category_code, brand, "
        "price, user_id, user_session)")

USER_DAYS = "user_days AS (SELECT DISTINCT user_id, event_date FROM behavior)"
COHORTS = ("cohorts AS (SELECT user_id, min(event_date) AS cohort_date FROM user_days "
           "GROUP BY user_id)")
SIZES = ("sizes AS (SELECT cohort_date, CAST(count(*) AS INTEGER) AS cohort_users FROM cohorts "
         "GROUP BY cohort_date)")
CELLS = """cells AS (
  SELECT cohort_date, CAST(datediff('day', cohort_date, event_date) AS INTEGER) AS day_offset,
    CAST(count(DISTINCT user_id) AS INTEGER) AS retained_users
  FROM user_days JOIN cohorts USING (user_id)
  WHERE datediff('day', cohort_date, event_date) <= 30 GROUP BY ALL)"""
MATRIX = """matrix AS (
  SELECT cohort_date, day_offset, cohort_users, retained_users,
    round(retained_users / cohort_users, 6) AS retention_rate
  FROM cells JOIN sizes USING (cohort_date))"""
RETENTION = ", ".join([USER_DAYS, COHORTS, SIZES, CELLS, MATRIX])

COUNTS = """CAST(count(*) FILTER (event_type = 'view') AS BIGINT) AS view_cnt,
    CAST(count(*) FILTER (event_type = 'cart') AS BIGINT) AS cart_cnt,
    CAST(count(*) FILTER (event_type = 'purchase') AS BIGINT) AS purchase_cnt"""
VIEW_UV = "CAST(count(DISTINCT CASE WHEN event_type = 'view' THEN user_id END) AS BIGINT) AS view_uv"
CART_UV = "CAST(count(DISTINCT CASE WHEN event_type = 'cart' THEN user_id END) AS BIGINT) AS cart_uv"
BUY_UV = "CAST(count(DISTINCT CASE WHEN event_type = 'purchase' THEN user_id END) AS BIGINT)"
GMV = ("CAST(sum(CASE WHEN event_type = 'purchase' THEN price ELSE 0 END) AS DECIMAL(18,2)) "
       "AS gmv")
BUY_RATE = "CASE WHEN view_cnt > 0 THEN round(purchase_cnt / view_cnt, 6) END AS buy_rate"
CART_RATE = "CASE WHEN view_cnt > 0 THEN round(cart_cnt / view_cnt, 6) END AS cart_rate"

FUNNEL = f"""funnel AS (
  SELECT event_date, view_cnt, cart_cnt, purchase_cnt, view_uv, cart_uv, purchase_uv, gmv,
    {CART_RATE}, {BUY_RATE}
  FROM (SELECT event_date, {COUNTS}, {VIEW_UV}, {CART_UV}, {BUY_UV} AS purchase_uv, {GMV}
        FROM behavior GROUP BY event_date))"""

RFM = """rfm AS (
  SELECT user_id,
    CAST(datediff('day', max(event_date), (SELECT max(event_date) FROM behavior)) AS INTEGER)
      AS recency_days,
    CAST(count(*) AS BIGINT) AS frequency,
    CAST(sum(CASE WHEN event_type = 'purchase' THEN price ELSE 0 END) AS DECIMAL(18,2))
      AS monetary
  FROM behavior GROUP BY user_id)"""

_CUTS = ", ".join(
    f"quantile_disc({column}, 0.{2 * i}) AS {letter}{i}"
    for letter, column in (("r", "recency_days"), ("f", "frequency"), ("m", "monetary"))
    for i in range(1, 5))


def _high_is_good(column: str, letter: str) -> str:
    return (f"CASE WHEN {column} >= {letter}4 THEN 5 WHEN {column} >= {letter}3 THEN 4 "
            f"WHEN {column} >= {letter}2 THEN 3 WHEN {column} >= {letter}1 THEN 2 ELSE 1 END")


SCORES = f"""cuts AS (SELECT {_CUTS} FROM rfm), scores AS (
  SELECT user_id, recency_days, frequency, monetary,
    CAST(CASE WHEN recency_days <= r1 THEN 5 WHEN recency_days <= r2 THEN 4
      WHEN recency_days <= r3 THEN 3 WHEN recency_days <= r4 THEN 2 ELSE 1 END AS INTEGER)
      AS r_score,
    CAST({_high_is_good("frequency", "f")} AS INTEGER) AS f_score,
    CAST({_high_is_good("monetary", "m")} AS INTEGER) AS m_score
  FROM rfm, cuts)"""

_NAMES = " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(SEGMENT_NAMES, 1))
SEGMENTS = f"""clustered AS (
  SELECT *, CAST(CASE WHEN m_score = 5 THEN 0 WHEN m_score >= 4 THEN 1
    WHEN m_score >= 2 THEN 2 ELSE 3 END AS INTEGER) AS cluster_id FROM scores),
stats AS (
  SELECT cluster_id, avg(frequency) - avg(recency_days)
    + ln(1 + avg(CAST(monetary AS DOUBLE))) AS worth FROM clustered GROUP BY cluster_id),
names AS (
  SELECT cluster_id, CASE row_number() OVER (ORDER BY worth DESC, cluster_id) {_NAMES} END
    AS segment FROM stats),
profiles AS (SELECT * FROM clustered JOIN names USING (cluster_id)),
summary AS (
  SELECT segment, CAST(count(*) AS BIGINT) AS users,
    round(avg(recency_days), 1) AS avg_recency_days, round(avg(frequency), 1) AS avg_frequency,
    round(CAST(sum(monetary) AS DOUBLE) / count(*), 2) AS avg_monetary,
    CAST(sum(monetary) AS DECIMAL(18,2)) AS total_monetary
  FROM profiles GROUP BY segment)"""
SEGMENTED = ", ".join([BEHAVIOR_LI, RFM, SCORES, SEGMENTS])


def _windows(seconds: int, *keys: str, name: str = "windows") -> str:
    key = "".join(f"{k}, " for k in keys)
    return f"""{name} AS (
  SELECT * FROM (
    SELECT time_bucket(INTERVAL '{seconds} seconds', event_time, TIMESTAMP '1970-01-01')
        AS window_start,
      time_bucket(INTERVAL '{seconds} seconds', event_time, TIMESTAMP '1970-01-01')
        + INTERVAL '{seconds} seconds' AS window_end, {key}
      CAST(count(*) FILTER (event_type = 'view') AS BIGINT) AS pv,
      CAST(count(DISTINCT CASE WHEN event_type = 'view' THEN user_id END) AS BIGINT) AS uv,
      CAST(count(*) FILTER (event_type = 'purchase') AS BIGINT) AS purchase_cnt, {GMV}
    FROM behavior GROUP BY ALL)
  WHERE pv > 0 OR purchase_cnt > 0)"""


GLOBAL_SECOND = f"{BEHAVIOR}, {_windows(1)}"
GLOBAL_MINUTE = f"{BEHAVIOR}, {_windows(60)}"
BY_CATEGORY = f"{BEHAVIOR}, {_windows(60, 'category_id')}"
BY_BRAND = f"{BEHAVIOR}, {_windows(60, 'brand')}"
# A stream closes the windows its watermark has passed.
CLOSED = ("window_end <= date_trunc('millisecond', (SELECT max(event_time) FROM behavior)) "
          "- INTERVAL '30 seconds'")


def _newest(limit: int, *keys: str) -> str:
    key = "".join(f", {k}" for k in keys)
    order = f", gmv DESC{key}" if keys else ""
    return (f"SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start{key}, pv, uv, "
            f"purchase_cnt, gmv FROM (SELECT * FROM windows ORDER BY windows.window_start DESC"
            f"{order} LIMIT {limit})")


def _ranking(key: str, limit: int = 10, where: str = "") -> str:
    return (f"SELECT {key}, CAST(sum(pv) AS BIGINT) AS pv, "
            f"CAST(sum(purchase_cnt) AS BIGINT) AS purchase_cnt, "
            f"CAST(sum(gmv) AS DECIMAL(18,2)) AS gmv FROM windows {where} GROUP BY {key} "
            f"ORDER BY gmv DESC, {key} LIMIT {limit}")


PRODUCT_METRICS = f"""products AS (
  SELECT product_id, max(brand) AS brand,
    CAST(count(*) FILTER (event_type = 'view') AS BIGINT) AS pv,
    CAST(count(*) FILTER (event_type = 'purchase') AS BIGINT) AS purchase_cnt,
    CAST(count(DISTINCT user_id) AS BIGINT) AS uv, {GMV}
  FROM behavior GROUP BY product_id)"""
TOP_PRODUCTS = "SELECT * FROM products ORDER BY gmv DESC, product_id LIMIT 20"

ITEM = f"""SELECT event_date, product_id, category_id, brand, view_cnt, cart_cnt, purchase_cnt,
    view_uv, gmv, {BUY_RATE}
  FROM (SELECT event_date, category_id, product_id, max(brand) AS brand, {COUNTS}, {VIEW_UV}, {GMV}
        FROM behavior GROUP BY event_date, category_id, product_id)"""

CATEGORY = f"""SELECT event_date, category_id, category_code, view_cnt, cart_cnt, purchase_cnt,
    view_uv, product_cnt, gmv, {BUY_RATE}
  FROM (SELECT event_date, category_id, max(category_code) AS category_code, {COUNTS}, {VIEW_UV},
          CAST(count(DISTINCT product_id) AS BIGINT) AS product_cnt, {GMV}
        FROM behavior GROUP BY event_date, category_id)"""

# Half-up rounding of gmv / purchases done on whole cents.
AVG_PRICE = """CASE WHEN purchase_cnt > 0 THEN
    CAST(CAST((2 * CAST(gmv * 100 AS BIGINT) + purchase_cnt) // (2 * purchase_cnt) AS DECIMAL(18,0))
      * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2)) END AS avg_price"""
BRAND = f"""SELECT event_date, brand, view_cnt, cart_cnt, purchase_cnt, view_uv, buyer_uv,
    product_cnt, gmv, {AVG_PRICE}, {BUY_RATE}
  FROM (SELECT event_date, brand, {COUNTS}, {VIEW_UV}, {BUY_UV} AS buyer_uv,
          CAST(count(DISTINCT product_id) AS BIGINT) AS product_cnt, {GMV}
        FROM behavior GROUP BY event_date, brand)"""

ACTIVE = f"""SELECT d.event_date, dau, view_uv, purchase_uv, coalesce(new_user, 0) AS new_user,
    session_cnt
  FROM (SELECT event_date, CAST(count(DISTINCT user_id) AS BIGINT) AS dau, {VIEW_UV},
          {BUY_UV} AS purchase_uv, CAST(count(DISTINCT session_id) AS BIGINT) AS session_cnt
        FROM behavior GROUP BY event_date) d
  LEFT JOIN (SELECT cohort_date, CAST(count(*) AS BIGINT) AS new_user FROM cohorts
             GROUP BY cohort_date) n ON d.event_date = n.cohort_date"""

CURVE = """SELECT day_offset, CAST(sum(retained_users) AS BIGINT) AS retained_total,
    CAST(sum(cohort_users) AS BIGINT) AS cohort_total,
    round(sum(retained_users) / sum(cohort_users), 4) AS retention_rate
  FROM matrix WHERE day_offset <= 30 GROUP BY day_offset"""

DENSE_CURVE = """SELECT CAST(g.day_offset AS INTEGER) AS day_offset,
    CAST(sum(coalesce(retained_users, 0)) AS BIGINT) AS retained_total,
    CAST(sum(g.cohort_users) AS BIGINT) AS cohort_total,
    round(sum(coalesce(retained_users, 0)) / sum(g.cohort_users), 4) AS retention_rate
  FROM (SELECT cohort_date, cohort_users, unnest(generate_series(0, least(30,
          datediff('day', cohort_date, (SELECT max(event_date) FROM behavior))))) AS day_offset
        FROM sizes) g
  LEFT JOIN cells USING (cohort_date, day_offset) GROUP BY g.day_offset"""

DETAIL_COLUMNS = ("event_time, event_type, product_id, category_id, category_code, brand, price, "
                  "user_id, session_id, event_date")
# A raw line carries whole seconds.
BY_SECOND = f"SELECT * REPLACE (date_trunc('second', event_time) AS event_time) FROM behavior"


def _bucket(salt: str) -> str:
    return (f"CAST(CAST('0x' || substr(md5(CAST(user_id AS VARCHAR) || ':{salt}'), 1, 12) "
            "AS BIGINT) % 100 AS INTEGER)")


BUCKETS = ("buckets AS (SELECT user_id, "
           + ", ".join(f"{_bucket(salt)} AS {name}" for name, salt in (
               ("h_dev", "device"), ("h_os", "os"), ("h_br", "browser"), ("h_ctry", "country"),
               ("h_prov", "prov"), ("h_age", "age"), ("h_gen", "gender")))
           + " FROM (SELECT DISTINCT user_id FROM behavior))")

DIM = """dim AS (
  SELECT user_id, device,
    CASE WHEN device <> 'Web' THEN device WHEN h_os < 55 THEN 'Windows' ELSE 'macOS' END AS os,
    CASE WHEN device = 'iOS' THEN CASE WHEN h_br < 70 THEN 'Safari' ELSE 'Chrome' END
      WHEN device = 'Android' THEN CASE WHEN h_br < 82 THEN 'Chrome' ELSE 'Firefox' END
      WHEN h_br < 60 THEN 'Chrome' WHEN h_br < 80 THEN 'Edge' WHEN h_br < 92 THEN 'Firefox'
      ELSE 'Safari' END AS browser,
    country,
    CASE country
      WHEN '中国' THEN list_extract(['广东', '浙江', '江苏', '山东', '河南', '四川', '北京', '上海',
        '湖北', '福建'], h_prov % 10 + 1)
      WHEN '美国' THEN list_extract(['California', 'Texas', 'New York', 'Florida', 'Illinois'],
        h_prov % 5 + 1)
      ELSE '海外其他' END AS province,
    CASE WHEN h_age < 22 THEN '18-24' WHEN h_age < 60 THEN '25-34' WHEN h_age < 85 THEN '35-44'
      ELSE '45+' END AS age_group,
    CASE WHEN h_gen < 58 THEN '女' ELSE '男' END AS gender
  FROM (SELECT *,
          CASE WHEN h_dev < 35 THEN 'iOS' WHEN h_dev < 80 THEN 'Android' ELSE 'Web' END AS device,
          CASE WHEN h_ctry < 55 THEN '中国' WHEN h_ctry < 67 THEN '美国' WHEN h_ctry < 77 THEN '印度'
            WHEN h_ctry < 83 THEN '德国' WHEN h_ctry < 88 THEN '英国' WHEN h_ctry < 92 THEN '巴西'
            WHEN h_ctry < 96 THEN '日本' ELSE '其他' END AS country
        FROM buckets))"""
CLASH = ("CASE WHEN device = 'Web' THEN os NOT IN ('Windows', 'macOS') ELSE os <> device END")

SHIFT = (f"(SELECT TIMESTAMP '{ANCHOR}' - max({{time}}) FROM {{table}})")


def oracle_sql() -> dict[str, str]:
    b, li = f"WITH {BEHAVIOR}", f"WITH {BEHAVIOR_LI}"
    in_range = f"event_date BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'"
    sql = {
        # sources and sinks
        "bulk_load": f"""WITH {RAW} SELECT parsed_time AS event_time, event_type,
            CAST(product_id AS BIGINT) AS product_id, CAST(category_id AS BIGINT) AS category_id,
            category_code, CASE WHEN dirt = 6 THEN 'the "best", they say'
              WHEN brand = '' THEN 'unknown' ELSE brand END AS brand,
            CAST(coalesce(TRY_CAST(nullif(price, '') AS DECIMAL(10,2)), 0) AS DECIMAL(10,2)) AS price,
            coalesce(TRY_CAST(user_id AS BIGINT), 0) AS user_id, user_session AS session_id,
            CAST(parsed_time AS DATE) AS event_date FROM raw WHERE dirt NOT IN (1, 2, 3, 4, 5)""",
        "bulk_load_rejects": f"""WITH {RAW} SELECT CASE WHEN dirt <= 2 THEN 'fields'
              WHEN dirt = 3 THEN 'time' WHEN dirt = 4 THEN 'id' ELSE 'price' END AS reason,
              CAST(count(*) AS BIGINT) AS rows
            FROM raw WHERE dirt IN (1, 2, 3, 4, 5) GROUP BY ALL""",
        "read_pruned": f"{b} SELECT event_date, event_type, user_id, price FROM behavior "
                       f"WHERE {in_range}",
        "read_user_days": f"{b}, {USER_DAYS} SELECT * FROM user_days",
        "read_user_rfm": f"{b}, {RFM} SELECT * FROM rfm",
        "write_replace": f"{b}, {FUNNEL} SELECT * FROM funnel",
        "write_detail": f"{b} SELECT {DETAIL_COLUMNS} FROM behavior",
        "replay_write": f"{b} {BY_SECOND}",
        # cleaning and predicates
        "clean_events": f"{b} {BY_SECOND}",
        "parse_source_time": f"WITH {RAW} SELECT {LINE} AS value, parsed_time AS event_time "
                             "FROM raw",
        "coarse_valid": f"WITH {RAW} SELECT {LINE} AS value FROM raw WHERE user_id <> 'n/a'",
        "fill_unknown": f"""WITH {RAW} SELECT category_code,
            CASE brand WHEN '' THEN 'unknown' ELSE brand END AS brand,
            CAST(count(*) AS BIGINT) AS event_cnt FROM raw GROUP BY ALL""",
        "derive_event_date": f"{b} SELECT event_time, user_id, event_date FROM behavior",
        "filter_date_range": f"{b} SELECT {DETAIL_COLUMNS} FROM behavior WHERE {in_range}",
        "filter_known_brand": f"{b} SELECT product_id, brand, user_id FROM behavior "
                              "WHERE brand <> 'unknown'",
        "shift_event_time": f"""{b} SELECT event_time
            + {SHIFT.format(time='event_time', table='behavior')} AS event_time,
            user_id, product_id, event_type FROM behavior""",
        "shift_lines": f"""WITH {RAW} SELECT strftime(parsed_time
            + {SHIFT.format(time='parsed_time', table='raw')}, '%Y-%m-%d %H:%M:%S') || ' UTC'
            || substr({LINE}, length(event_time) + 1) AS value FROM raw""",
        "sort_replay": f"{b} SELECT event_time, user_id, product_id, event_type FROM behavior",
        "select_contract": f"{b}, {FUNNEL} SELECT * FROM funnel",
        # joins and retention
        "cohort_assign": f"{b}, {USER_DAYS}, {COHORTS} SELECT user_id, event_date, cohort_date "
                         "FROM user_days JOIN cohorts USING (user_id)",
        "cohort_rate_join": f"{b}, {RETENTION} SELECT * FROM matrix",
        "cohort_first_date": f"{b}, {USER_DAYS}, {COHORTS} SELECT * FROM cohorts",
        "retention_matrix": f"{b}, {RETENTION} SELECT * FROM matrix",
        "retention_matrix_li": f"{li}, {RETENTION} SELECT * FROM matrix",
        "retention_curve": f"{b}, {RETENTION} {CURVE}",
        "retention_curve_dense": f"{li}, {RETENTION} {DENSE_CURVE}",
        # aggregations
        "cond_count_daily": f"{b} SELECT event_date, {COUNTS} FROM behavior GROUP BY event_date",
        "cond_distinct_daily": f"{b} SELECT event_date, {VIEW_UV}, {CART_UV}, "
                               f"{BUY_UV} AS purchase_uv FROM behavior GROUP BY event_date",
        "cond_sum_daily": f"{b} SELECT event_date, {GMV} FROM behavior GROUP BY event_date",
        "funnel_daily": f"{b}, {FUNNEL} SELECT * FROM funnel",
        "funnel_daily_li": f"{li}, {FUNNEL} SELECT * FROM funnel",
        "distinct_rows": f"{b} SELECT DISTINCT user_id FROM behavior",
        "ref_date": f"{b} SELECT max(event_date) AS ref_date FROM behavior",
        "rfm_base": f"{li}, {RFM} SELECT * FROM rfm",
        "rfm_quantiles": f"{li}, {RFM} " + " UNION ALL ".join(
            f"SELECT '{c}' AS metric, " + ", ".join(
                f"quantile_disc(CAST({c} AS DECIMAL(18,2)), 0.{2 * i}) AS q{20 * i}"
                for i in range(1, 5)) + " FROM rfm"
            for c in ("recency_days", "frequency", "monetary")),
        "rfm_scores": f"{li}, {RFM}, {SCORES} SELECT * FROM scores",
        "active_user_daily": f"{b}, {USER_DAYS}, {COHORTS} {ACTIVE}",
        "active_user_daily_li": f"{li}, {USER_DAYS}, {COHORTS} {ACTIVE}",
        "item_stats_daily": f"{b} {ITEM}",
        "item_stats_daily_li": f"{li} {ITEM}",
        "category_stats_daily": f"{b} {CATEGORY}",
        "category_stats_daily_li": f"{li} {CATEGORY}",
        "brand_stats_daily": f"{b} {BRAND}",
        "brand_stats_daily_li": f"{li} {BRAND}",
        "any_brand": f"{b} SELECT product_id, max(brand) AS brand FROM behavior "
                     "GROUP BY product_id",
        "user_uv_by_brand": f"{b} SELECT brand, CAST(count(DISTINCT user_id) AS BIGINT) AS uv "
                            "FROM behavior GROUP BY brand",
        "user_uv_by_category": f"{li} SELECT category_id, CAST(count(DISTINCT user_id) AS BIGINT)"
                               " AS uv FROM behavior GROUP BY category_id",
        "approx_uv_by_brand": f"{li} SELECT brand, CAST(count(DISTINCT user_id) AS BIGINT) AS uv, "
                              "true AS approx_within_bound FROM behavior GROUP BY brand",
        # segments
        "rfm_kmeans": f"{li}, {RFM} SELECT user_id, true AS own_centre_nearest FROM rfm",
        "cluster_stats": f"""{li}, {RFM} SELECT true AS every_cluster_used,
            CAST(count(*) AS BIGINT) AS users, round(avg(recency_days), 4) AS avg_r,
            round(avg(frequency), 4) AS avg_f, round(avg(CAST(monetary AS DOUBLE)), 4) AS avg_m
            FROM rfm""",
        "user_profile": f"""{li}, {RFM}, {SCORES} SELECT *,
            TIMESTAMP '{ANCHOR}' AS computed_at, true AS one_name FROM scores""",
        "profile_from_saved_model": f"""{li}, {RFM} SELECT user_id, recency_days, frequency, monetary,
            true AS as_the_model_says FROM rfm""",
        "rfm_features": f"""{li}, {RFM}, f AS (SELECT user_id, recency_days AS r,
              ln(1 + CAST(frequency AS DOUBLE)) AS lf, ln(1 + CAST(monetary AS DOUBLE)) AS lm
              FROM rfm)
            SELECT user_id, round(lf, 6) AS log_f, round(lm, 6) AS log_m,
              round((r - avg(r) OVER ()) / stddev_samp(r) OVER (), 5) AS z_recency,
              round((lf - avg(lf) OVER ()) / stddev_samp(lf) OVER (), 5) AS z_log_f,
              round((lm - avg(lm) OVER ()) / stddev_samp(lm) OVER (), 5) AS z_log_m FROM f""",
        "segment_names": f"WITH {SEGMENTED} SELECT cluster_id, segment FROM names",
        "segment_summary": f"WITH {SEGMENTED} SELECT * FROM summary",
        "segment_totals": f"""WITH {SEGMENTED} SELECT CAST(count(*) AS BIGINT) AS total_users,
            CAST(sum(monetary) AS DECIMAL(18,2)) AS total_monetary,
            CAST(count(*) FILTER (segment = '{HIGH_VALUE}') AS BIGINT) AS high_value_users,
            CAST(sum(CASE WHEN segment = '{HIGH_VALUE}' THEN monetary ELSE 0 END)
              AS DECIMAL(18,2)) AS high_value_monetary FROM profiles""",
        # latest-wins, ordering
        "latest_by_key": f"""{b} SELECT user_id, brand, event_time, event_type, product_id, price
            FROM behavior QUALIFY row_number() OVER (PARTITION BY user_id, brand
              ORDER BY event_time DESC, event_type DESC, product_id DESC, price DESC) = 1""",
        "latest_of_replays": f"""{b}, {_windows(3600, 'brand')}
            SELECT window_start, window_end, brand,
              CASE WHEN purchase_cnt > 0 THEN 0 ELSE pv END AS pv,
              CASE WHEN purchase_cnt > 0 THEN 0 ELSE uv END AS uv, purchase_cnt, gmv
            FROM windows""",
        "order_limit": f"{li} SELECT user_id, product_id, event_date, price FROM behavior "
                       "ORDER BY price DESC, user_id, product_id, event_date LIMIT 30",
        "rank_position": f"""WITH {BY_BRAND}, top AS (
            {_ranking('brand', where="WHERE brand <> 'unknown'")})
            SELECT CAST(row_number() OVER (ORDER BY gmv DESC, brand) AS INTEGER) AS rank, brand,
              gmv FROM top""",
        # windows
        "win_global": f"WITH {GLOBAL_SECOND} SELECT * FROM windows",
        "win_global_minute": f"WITH {GLOBAL_MINUTE} SELECT * FROM windows",
        "win_category": f"WITH {BY_CATEGORY} SELECT * FROM windows",
        "win_brand": f"WITH {BY_BRAND} SELECT * FROM windows",
        "pv_uv_agg": f"""{b}, {_windows(365 * 86400, 'brand')}
            SELECT window_start, brand, pv, uv, purchase_cnt, gmv FROM windows""",
        "drop_empty_window": f"""WITH {GLOBAL_MINUTE} SELECT DISTINCT
            date_trunc('minute', event_time) AS window_start FROM behavior
            WHERE date_trunc('minute', event_time) NOT IN (SELECT window_start FROM windows)""",
        # streaming
        "stream_source": f"{b} SELECT event_type, CAST(count(*) AS BIGINT) AS event_cnt "
                         "FROM behavior GROUP BY event_type",
        "stream_detail": f"{b} SELECT {DETAIL_COLUMNS} FROM behavior",
        "stream_global": f"WITH {GLOBAL_SECOND} SELECT * FROM windows WHERE {CLOSED}",
        "stream_category": f"WITH {BY_CATEGORY} SELECT * FROM windows WHERE {CLOSED}",
        "stream_brand": f"WITH {BY_BRAND} SELECT * FROM windows WHERE {CLOSED}",
        "stream_late": f"""WITH {BEHAVIOR.replace("behavior AS", "kept AS", 1)},
            behavior AS (
              SELECT event_time, event_type, user_id, price FROM kept UNION ALL
              SELECT (SELECT max(event_time) FROM kept) - INTERVAL '10 seconds', 'view', -1, 0
              FROM range(50)), {_windows(60)} SELECT * FROM windows""",
        "stream_idle_source": f"WITH {GLOBAL_MINUTE} SELECT * FROM windows WHERE {CLOSED}",
        "replay_published": f"""WITH {BEHAVIOR.replace("behavior AS", "exact AS", 1)},
            behavior AS (SELECT * REPLACE (date_trunc('second', event_time) AS event_time)
              FROM exact), {_windows(60)} SELECT * FROM windows WHERE {CLOSED}""",
        "stream_fan_out": f"""WITH {GLOBAL_SECOND}, {_windows(60, 'category_id', name='categories')},
            {_windows(60, 'brand', name='brands')}
            SELECT 'ads_realtime_pv_uv' AS name, CAST(count(*) AS BIGINT) AS rows FROM windows
              WHERE {CLOSED}
            UNION ALL SELECT 'ads_realtime_category_stats', count(*) FROM categories WHERE {CLOSED}
            UNION ALL SELECT 'ads_realtime_brand_stats', count(*) FROM brands WHERE {CLOSED}
            UNION ALL SELECT 'dwd_user_behavior', count(*) FROM behavior""",
        # tables kept day by day
        "retention_incremental": f"{b}, {RETENTION} SELECT * FROM matrix",
        "active_user_incremental": f"{b}, {USER_DAYS}, {COHORTS} {ACTIVE}",
        "users_by_key": f"{b}, {BUCKETS}, {DIM} SELECT * FROM dim",
        "uv_range_sketch": f"""{b} SELECT brand, CAST(count(*) AS BIGINT) AS uv,
              CAST(count(*) FILTER (v > 0) AS BIGINT) AS view_uv,
              CAST(count(*) FILTER (p > 0) AS BIGINT) AS buyer_uv,
              CAST(count(*) FILTER (v > 0 AND p > 0) AS BIGINT) AS viewer_buyer_uv,
              true AS approx_within_bound
            FROM (SELECT brand, user_id, count(*) FILTER (event_type = 'view') AS v,
                    count(*) FILTER (event_type = 'purchase') AS p
                  FROM behavior WHERE {in_range} GROUP BY ALL) GROUP BY brand""",
        "uv_total_sketch": f"""{b} SELECT CAST(count(DISTINCT user_id) AS BIGINT) AS uv,
            true AS approx_within_bound FROM behavior WHERE {in_range}""",
        "price_points_sketch": f"""{b} SELECT brand, CAST(count(*) AS BIGINT) AS purchases,
            true AS ranks_within_bound FROM behavior
            WHERE {in_range} AND event_type = 'purchase' GROUP BY brand""",
        "win_hour_rolled": f"""{b}, {_windows(3600, 'brand')}
            SELECT *, true AS approx_within_bound FROM windows""",
        "profiles_by_key": f"""{li}, {RFM}, {SCORES} SELECT *,
            CAST(CASE WHEN m_score = 5 THEN 0 WHEN m_score >= 4 THEN 1 WHEN m_score >= 2 THEN 2
              ELSE 3 END AS INTEGER) AS cluster_id,
            CASE WHEN user_id % 7 = 0 THEN 'again' ELSE '' END AS segment,
            TIMESTAMP '{ANCHOR}' AS computed_at FROM scores""",
        # synthetic users
        "salted_buckets": f"{li}, {BUCKETS} SELECT * FROM buckets",
        "dim_user": f"{li}, {BUCKETS}, {DIM} SELECT * FROM dim",
        "dim_checks": f"""{li}, {BUCKETS}, {DIM} SELECT attribute, value,
              CAST(count(*) AS BIGINT) AS users,
              CAST(count(*) FILTER (clash) AS BIGINT) AS contradictory_users
            FROM (SELECT 'device' AS attribute, device AS value,
                    {CLASH} AS clash FROM dim
                  UNION ALL SELECT 'country', country, {CLASH} FROM dim) GROUP BY ALL""",
        # serving
        "overview": f"WITH {GLOBAL_SECOND} {_newest(30)}",
        "category_stats": f"WITH {BY_CATEGORY} {_newest(20, 'category_id')}",
        "brand_stats": f"WITH {BY_BRAND} {_newest(20, 'brand')}",
        "brand_ranking": f"""WITH {BY_BRAND}
            {_ranking('brand', where="WHERE brand <> 'unknown'")}""",
        "category_ranking": f"WITH {BY_CATEGORY} {_ranking('category_id')}",
        "product_ranking": f"{b}, {PRODUCT_METRICS} {TOP_PRODUCTS}",
        "product_ranking_li": f"{li}, {PRODUCT_METRICS} {TOP_PRODUCTS}",
        "product_ranking_approx": f"""{li}, {PRODUCT_METRICS}, top AS ({TOP_PRODUCTS})
            SELECT *, true AS approx_within_bound FROM top""",
        "product_metrics": f"{li}, {PRODUCT_METRICS} SELECT * FROM products",
        "funnel_report": f"""{b}, {FUNNEL} SELECT CAST(event_date AS VARCHAR) AS event_date,
            view_cnt, cart_cnt, purchase_cnt, view_uv, purchase_uv, gmv,
            round(cart_rate * 100, 3) AS cart_rate_pct, round(buy_rate * 100, 3) AS buy_rate_pct
            FROM funnel ORDER BY funnel.event_date DESC LIMIT 30""",
        "retention": f"{b}, {RETENTION} {CURVE}",
        "avg_order_value": f"""WITH {BY_CATEGORY}, top AS ({_ranking('category_id')})
            SELECT category_id, round(CASE WHEN purchase_cnt = 0 THEN 0
              ELSE CAST(gmv AS DOUBLE) / purchase_cnt END, 2) AS avg_order_value FROM top""",
        "funnel_stages": f"""{b}, {FUNNEL}, day AS (
              SELECT *, CASE WHEN view_cnt = 0 THEN 0 ELSE cart_cnt / view_cnt END AS c,
                CASE WHEN view_cnt = 0 THEN 0 ELSE purchase_cnt / view_cnt END AS p
              FROM funnel ORDER BY event_date DESC LIMIT 1)
            SELECT event_date, 1 AS position, 'view' AS stage, view_cnt AS event_cnt,
              CAST(1 AS DOUBLE) AS ratio, round(100 - c * 100, 1) AS loss_pct FROM day
            UNION ALL SELECT event_date, 2, 'cart', cart_cnt, round(c, 6),
              round(100 - p * 100, 1) FROM day
            UNION ALL SELECT event_date, 3, 'purchase', purchase_cnt, round(p, 6), NULL
            FROM day""",
        "high_value_share": f"""WITH {SEGMENTED} SELECT segment,
              round(users / (SELECT sum(users) FROM summary), 6) AS user_share,
              round(CAST(total_monetary AS DOUBLE)
                / CAST((SELECT sum(total_monetary) FROM summary) AS DOUBLE), 6) AS monetary_share
            FROM summary WHERE segment = '{HIGH_VALUE}'""",
        "day1_retention": f"{b}, {RETENTION}, curve AS ({CURVE}) "
                          "SELECT day_offset, retention_rate FROM curve WHERE day_offset = 1",
        "latest_kpi": f"""WITH {GLOBAL_SECOND}, newest AS ({_newest(1)})
            SELECT window_start, pv, uv, gmv FROM newest""",
        "pv_trend": f"WITH {GLOBAL_SECOND}, newest AS ({_newest(60)}) "
                    "SELECT window_start, pv FROM newest",
    }
    sql["cohort_assign_join"] = sql["cohort_assign"]
    sql["global_sort"] = sql["retention_matrix"]
    sql["exactly_once_resume"] = sql["stream_brand"]
    sql["product_ranking_seeking"] = sql["product_ranking_li"]
    sql["product_ranking_from_items"] = sql["product_ranking_li"]
    sql["stream_compacted"] = sql["stream_brand"]
    sql["windows_backfill"] = sql["win_brand"]
    for name in ("overview", "category_stats", "brand_stats", "latest_kpi", "pv_trend"):
        sql[f"{name}_stored"] = sql[name]
    sql["user_segments"] = sql["segment_summary"]
    sql["user_segments_summary"] = sql["segment_totals"]
    return sql
