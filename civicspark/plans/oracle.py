"""Independent SQL for each registered query (DuckDB dialect), over the
plain test tables.  The JSON payload round trip of the Spark side is not
repeated here: the oracle states the expected values directly."""

from __future__ import annotations

ISO = "'%Y-%m-%dT%H:%M:%S.%g'"
FIXED = "TIMESTAMP '2024-02-01 06:00:00'"
EARLIER = "TIMESTAMP '2024-01-15 00:00:00'"


def _bound(expr: str, days: int) -> str:
    return f"CAST(CAST({expr} - INTERVAL {days} DAY AS DATE) AS TIMESTAMP)"


REQUEST_ROWS = f"""
SELECT CAST(e.event_id AS VARCHAR) AS unique_key,
  strftime(e.ts, {ISO}) AS created_date,
  CASE e.event_id % 3 WHEN 0 THEN strftime(e.ts + INTERVAL 1 HOUR, {ISO})
                      WHEN 1 THEN NULL ELSE '' END AS closed_date,
  e.event_type AS complaint_type,
  e.props AS descriptor,
  CAST(e.user_id + 10000 AS VARCHAR) AS incident_zip,
  CASE e.event_id % 3 WHEN 0 THEN 'user ' || CAST(e.user_id AS VARCHAR)
                      WHEN 1 THEN '' ELSE NULL END AS incident_address,
  'NEW YORK' AS city,
  r.r_name AS borough,
  printf('%.2f', e.value) AS latitude,
  printf('-%.2f', e.value) AS longitude,
  CASE WHEN e.event_type = 'error' THEN 'Open' ELSE 'Closed' END AS status,
  CASE WHEN e.event_id % 5 = 0 THEN 'resolved ' || e.event_type ELSE '' END AS resolution_description,
  'AG' || CAST(e.user_id % 7 AS VARCHAR) AS agency,
  '' AS agency_name
FROM events e LEFT JOIN region r ON r.r_regionkey = e.user_id % 5
"""

SURVEY_ROWS = """
SELECT c_name AS name, c_custkey, c_nationkey, c_acctbal,
  CAST(c_custkey % 50 * 20 AS VARCHAR) AS pop_text,
  CASE c_custkey % 10 WHEN 0 THEN 'N/A' WHEN 1 THEN '-666666666'
       ELSE CAST(c_acctbal AS VARCHAR) END AS income_text,
  CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE CAST(c_custkey % 7 AS VARCHAR) END AS below_text,
  CAST(c_nationkey * 100 + 1 AS VARCHAR) AS housing_text,
  CASE WHEN c_custkey % 17 = 0 THEN 'x' ELSE CAST(c_custkey % 31 AS VARCHAR) END AS workers_text,
  CASE WHEN c_nationkey % 5 = 4 THEN '36' WHEN c_custkey % 19 = 0 THEN NULL ELSE '36' END AS state_text,
  CASE c_custkey % 6 WHEN 0 THEN '061' WHEN 1 THEN '005' WHEN 2 THEN '047' WHEN 3 THEN '081'
       WHEN 4 THEN '085' ELSE '999' END AS county_text
FROM customer
"""

BOROUGHS = """(VALUES ('061', 'Manhattan'), ('005', 'Bronx'), ('047', 'Brooklyn'),
                 ('081', 'Queens'), ('085', 'Staten Island')) AS m(code, borough)"""

SURVEY_CLEAN = f"""
WITH s AS ({SURVEY_ROWS}),
v AS (
  SELECT name, county_text, state_text,
    CAST(c_custkey % 50 * 20 AS DOUBLE) AS total_population,
    CASE WHEN c_custkey % 10 IN (0, 1) OR c_acctbal < 0 THEN NULL ELSE c_acctbal END
      AS median_household_income,
    CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE CAST(c_custkey % 7 AS DOUBLE) END
      AS population_below_poverty,
    CAST(c_nationkey * 100 + 1 AS DOUBLE) AS total_housing_units,
    CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE CAST(c_custkey % 31 AS DOUBLE) END
      AS total_workers_commuting
  FROM s)
SELECT v.name, COALESCE(m.borough, 'Unknown') AS borough, v.county_text AS county_fips,
  v.state_text AS state_fips, CAST(2022 AS INTEGER) AS survey_year,
  total_population, median_household_income, population_below_poverty,
  total_housing_units, total_workers_commuting,
  CASE WHEN total_population > 0 AND population_below_poverty IS NOT NULL
       THEN CAST(printf('%.2f', population_below_poverty / total_population * 100) AS DOUBLE) END AS poverty_rate_pct,
  {FIXED} AS _ingested_at, 'us_census_bureau_acs5' AS _source
FROM v LEFT JOIN {BOROUGHS} ON m.code = v.county_text
"""

INITCAP_REGION = ("list_aggregate(list_transform(string_split(lower(r.r_name), ' '), "
                  "lambda x: upper(x[1]) || x[2:]), 'string_agg', ' ')")

WEATHER_ROWS = f"""
SELECT e.event_id, e.ts,
  {INITCAP_REGION} AS borough,
  CASE WHEN e.event_id % 7 <> 0 THEN 'Station ' || CAST(e.user_id AS VARCHAR) ELSE '' END AS city_name,
  e.value AS lat, -e.value AS lon,
  CASE WHEN e.event_id % 5 <> 0 THEN 'US' ELSE '' END AS country,
  CASE WHEN e.value > 25 THEN 'Rain' ELSE 'Clear' END AS weather_main,
  CASE WHEN e.value > 25 THEN 'light rain' ELSE 'clear sky' END AS weather_description,
  CASE WHEN e.value > 25 THEN '10d' ELSE '01d' END AS weather_icon,
  e.value AS temp_celsius, e.value - 1.5 AS feels_like_celsius,
  e.value - 2 AS temp_min_celsius, e.value + 2 AS temp_max_celsius,
  CAST(e.user_id % 30 + 1000 AS DOUBLE) AS pressure_hpa,
  CAST(e.event_id % 100 AS DOUBLE) AS humidity_pct,
  CASE WHEN e.event_id % 4 <> 0 THEN CAST(10000 AS DOUBLE) END AS visibility_meters,
  e.value / 10 AS wind_speed_ms,
  CAST(e.event_id % 360 AS DOUBLE) AS wind_direction_deg,
  CAST(e.user_id % 100 AS DOUBLE) AS cloudiness_pct,
  CASE WHEN e.event_id % 3 = 0 THEN e.value / 10 END AS rain_1h_mm,
  CASE WHEN e.event_id % 10 = 0 THEN CAST(0.5 AS DOUBLE) END AS snow_1h_mm,
  date_trunc('second', e.ts) AS observation_timestamp,
  date_trunc('second', e.ts) - INTERVAL 6 HOUR AS sunrise_timestamp,
  date_trunc('second', e.ts) + INTERVAL 6 HOUR AS sunset_timestamp
FROM events e LEFT JOIN region r ON r.r_regionkey = e.user_id % 5
WHERE e.event_type = 'view'
"""

WEATHER_COLS = ("borough, city_name, lat, lon, country, weather_main, weather_description, "
                "weather_icon, temp_celsius, feels_like_celsius, temp_min_celsius, temp_max_celsius, "
                "pressure_hpa, humidity_pct, visibility_meters, wind_speed_ms, wind_direction_deg, "
                "cloudiness_pct, rain_1h_mm, snow_1h_mm, observation_timestamp, sunrise_timestamp, "
                "sunset_timestamp")

ORDER_DEMOGRAPHICS = f"""
WITH a AS (
  SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS survey_year, o_orderkey % 2 AS side,
    CAST(count(*) AS DOUBLE) AS total_population,
    max(o_totalprice) AS median_household_income,
    CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) AS population_below_poverty,
    CAST(count(*) FILTER (WHERE o_orderstatus = 'O') AS DOUBLE) AS total_housing_units,
    CAST(NULLIF(count(*) FILTER (WHERE o_orderstatus = 'P'), 0) AS DOUBLE) AS total_workers_commuting
  FROM orders GROUP BY 1, 2, 3)
SELECT 'C' || CAST(o_custkey AS VARCHAR) AS borough,
  CASE side WHEN 0 THEN 'T' ELSE 'S' END AS county_fips, '36' AS state_fips, survey_year,
  total_population, median_household_income, population_below_poverty,
  total_housing_units, total_workers_commuting,
  CASE WHEN total_population > 0 AND population_below_poverty IS NOT NULL
       THEN CAST(printf('%.2f', population_below_poverty / total_population * 100) AS DOUBLE) END AS poverty_rate_pct,
  CASE side WHEN 0 THEN {EARLIER} ELSE {FIXED} END AS _ingested_at,
  CASE side WHEN 0 THEN 'target_load' ELSE 'source_load' END AS _source,
  side
FROM a
"""

_UPD = ["total_population", "median_household_income", "population_below_poverty",
        "total_housing_units", "total_workers_commuting", "poverty_rate_pct", "_ingested_at"]
_KEEP = ["county_fips", "state_fips", "_source"]
CENSUS_MERGE = (
    f"WITH r AS ({ORDER_DEMOGRAPHICS}), t AS (SELECT * FROM r WHERE side = 0), "
    "s AS (SELECT * FROM r WHERE side = 1)\nSELECT "
    "CASE WHEN t.side IS NOT NULL THEN t.borough ELSE s.borough END AS borough, "
    + ", ".join(f"CASE WHEN t.side IS NOT NULL THEN t.{c} ELSE s.{c} END AS {c}" for c in _KEEP)
    + ", CASE WHEN t.side IS NOT NULL THEN t.survey_year ELSE s.survey_year END AS survey_year, "
    + ", ".join(f"CASE WHEN s.side IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}" for c in _UPD)
    + "\nFROM t FULL OUTER JOIN s ON t.borough = s.borough AND t.survey_year = s.survey_year"
)

ROW_IDX = "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS idx FROM events"

SQL = {
    "requests_project": REQUEST_ROWS,
    "requests_default_missing": REQUEST_ROWS,
    "requests_union_pages": f"""
WITH b AS (SELECT max(ts) AS m FROM events)
SELECT CAST(event_id AS VARCHAR) AS unique_key, strftime(ts, {ISO}) AS created_date,
  'historical' AS _ingestion_mode FROM events, b WHERE ts >= {_bound('b.m', 90)}
UNION ALL
SELECT CAST(event_id AS VARCHAR), strftime(ts, {ISO}), 'incremental'
FROM events, b WHERE ts >= {_bound('b.m', 3)}""",
    "lookback_incremental": f"""
WITH b AS (SELECT {_bound('max(ts)', 3)} AS since FROM events)
SELECT event_id, ts, since FROM events, b WHERE ts >= since""",
    "lookback_historical": f"""
WITH b AS (SELECT {_bound('max(o_orderdate)', 90)} AS since FROM orders)
SELECT o_orderkey, o_orderdate, since FROM orders, b WHERE o_orderdate >= since""",
    "page_slice": """
SELECT event_id, ts, user_id, event_type FROM events ORDER BY ts, event_id LIMIT 1000 OFFSET 1000""",
    "page_index": f"""
WITH r AS ({ROW_IDX}), n AS (SELECT count(*) AS total FROM events),
p AS (SELECT idx // 1000 AS page_no, count(*) AS n_rows, arg_min(event_id, idx) AS first_key,
             arg_max(event_id, idx) AS last_key FROM r GROUP BY 1)
SELECT CAST(page_no AS BIGINT) AS page_no, n_rows, first_key, last_key,
  (page_no + 1) * 1000 >= total AS is_last,
  ((page_no + 1) * 1000 >= total) AND n_rows = 1000 AS extra_fetch
FROM p, n""",
    "load_batches": f"""
WITH r AS ({ROW_IDX}),
b AS (SELECT idx // 5000 + 1 AS batch_no, count(*) AS n_rows, arg_min(event_id, idx) AS first_key,
             arg_max(event_id, idx) AS last_key FROM r GROUP BY 1)
SELECT CAST(batch_no AS BIGINT) AS batch_no, n_rows, first_key, last_key,
  CAST((batch_no - 1) * 5000 + n_rows AS BIGINT) AS running_total FROM b""",
    "load_counts": f"""
WITH b AS (SELECT max(ts) AS m FROM events)
SELECT 'nyc_open_data_311' AS _source, 'historical' AS _ingestion_mode, count(*) AS loaded_rows
FROM events, b WHERE ts >= {_bound('b.m', 90)}
UNION ALL
SELECT 'nyc_open_data_311', 'incremental', count(*) FROM events, b WHERE ts >= {_bound('b.m', 3)}
UNION ALL
SELECT 'openweather_api', CAST(NULL AS VARCHAR), count(*) FROM events WHERE event_type = 'view'""",
    "county_filter": f"""
WITH s AS ({SURVEY_ROWS})
SELECT name, county_text AS county_fips, state_text AS state_fips FROM s
WHERE county_text IN ('061', '005', '047', '081', '085') AND state_text = '36'""",
    "fips_lookup": f"""
WITH s AS ({SURVEY_ROWS})
SELECT s.name, s.county_text AS county_fips, COALESCE(m.borough, 'Unknown') AS borough
FROM s LEFT JOIN {BOROUGHS} ON m.code = s.county_text""",
    "weather_flatten": f"""
SELECT {WEATHER_COLS}, {FIXED} AS _ingested_at, 'openweather_api' AS _source
FROM ({WEATHER_ROWS})""",
    "weather_required_fields": """
SELECT CASE event_id % 10 WHEN 1 THEN 'coord.lat' WHEN 2 THEN 'weather[0].main'
  WHEN 3 THEN 'main.humidity' WHEN 4 THEN 'sys.sunrise' WHEN 5 THEN 'rain' WHEN 6 THEN 'wind'
  WHEN 7 THEN 'dt' ELSE 'ok' END AS reason, count(*) AS n
FROM events WHERE event_type = 'view' GROUP BY 1""",
    "weather_epoch": """
SELECT event_id, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS epoch_s,
  date_trunc('second', ts) AS observation_timestamp FROM events""",
    "iso_to_timestamp": f"""
SELECT event_id, strftime(ts, {ISO}) || CASE WHEN event_id % 2 = 0 THEN '+00:00' ELSE '' END AS iso_text,
  date_trunc('millisecond', ts) AS parsed FROM events""",
    "census_header_rows": f"""
SELECT name, pop_text, income_text, below_text, housing_text, workers_text, state_text,
  county_text FROM ({SURVEY_ROWS})""",
    "census_clean": SURVEY_CLEAN,
    "poverty_rate": """
WITH o AS (SELECT o_custkey, count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'F') AS f
           FROM orders GROUP BY 1)
SELECT c.c_custkey, COALESCE(o.n, 0) AS total_orders, COALESCE(o.f, 0) AS f_orders,
  CASE WHEN o.n > 0 THEN CAST(printf('%.2f', CAST(o.f AS DOUBLE) / o.n * 100) AS DOUBLE) END AS poverty_rate_pct
FROM customer c LEFT JOIN o ON o.o_custkey = c.c_custkey""",
    "census_merge": CENSUS_MERGE,
    "requests_append": f"""
WITH b AS (SELECT max(ts) AS m FROM events)
SELECT CAST(event_id AS VARCHAR) AS unique_key, strftime(ts, {ISO}) AS created_date,
  'historical' AS _ingestion_mode, {EARLIER} AS _ingested_at, 'nyc_open_data_311' AS _source
FROM events, b WHERE ts >= {_bound('b.m', 90)}
UNION ALL
SELECT CAST(event_id AS VARCHAR), strftime(ts, {ISO}), 'incremental', {FIXED}, 'nyc_open_data_311'
FROM events, b WHERE ts >= {_bound('b.m', 3)}""",
    "weather_append": f"""
WITH w AS ({WEATHER_ROWS}), b AS (SELECT max(ts) AS m FROM events)
SELECT borough, observation_timestamp, temp_celsius, rain_1h_mm, {EARLIER} AS _ingested_at,
  'openweather_api' AS _source FROM w
UNION ALL
SELECT borough, observation_timestamp, temp_celsius, rain_1h_mm, {FIXED}, 'openweather_api'
FROM w, b WHERE observation_timestamp >= {_bound('b.m', 3)}""",
    "lineage_columns": f"""
WITH b AS (SELECT max(ts) AS m FROM events)
SELECT CAST(event_id AS VARCHAR) AS unique_key, {FIXED} AS _ingested_at,
  'incremental' AS _ingestion_mode, 'nyc_open_data_311' AS _source
FROM events, b WHERE ts >= {_bound('b.m', 3)}""",
    "length_violations": """
SELECT 'event_type' AS column_name, 5 AS max_len,
  CAST(count(*) FILTER (WHERE length(event_type) > 5) AS BIGINT) AS n_over,
  CAST(max(length(event_type)) AS INTEGER) AS longest FROM events
UNION ALL
SELECT 'props', 9, CAST(count(*) FILTER (WHERE length(props) > 9) AS BIGINT),
  CAST(max(length(props)) AS INTEGER) FROM events""",
    "table_contract": f"""
SELECT CAST(event_id AS VARCHAR) AS unique_key, strftime(ts, {ISO}) AS created_date,
  CAST(NULL AS VARCHAR) AS closed_date, event_type AS complaint_type,
  CAST(NULL AS VARCHAR) AS descriptor, CAST(NULL AS VARCHAR) AS incident_zip,
  CAST(NULL AS VARCHAR) AS incident_address, CAST(NULL AS VARCHAR) AS city,
  CAST(NULL AS VARCHAR) AS borough, CAST(NULL AS VARCHAR) AS latitude,
  CAST(NULL AS VARCHAR) AS longitude, CAST(NULL AS VARCHAR) AS status,
  CAST(NULL AS VARCHAR) AS resolution_description, CAST(NULL AS VARCHAR) AS agency,
  CAST(NULL AS VARCHAR) AS agency_name, {FIXED} AS _ingested_at,
  'incremental' AS _ingestion_mode, 'nyc_open_data_311' AS _source
FROM events""",
    "latest_request": """
SELECT user_id, event_id, ts, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "requests_latest": f"""
WITH b AS (SELECT max(ts) AS m FROM events)
SELECT CAST(event_id AS VARCHAR) AS unique_key,
  CASE WHEN event_type = 'error' THEN 'Open' ELSE 'Closed' END AS status,
  CASE WHEN ts >= {_bound('b.m', 3)} THEN {FIXED} ELSE {EARLIER} END AS _ingested_at,
  CASE WHEN ts >= {_bound('b.m', 3)} THEN 'incremental' ELSE 'historical' END AS _ingestion_mode
FROM events, b WHERE ts >= {_bound('b.m', 90)}""",
    "requests_daily": """
SELECT r.r_name AS borough, CAST(e.ts AS DATE) AS local_day, count(*) AS n_requests
FROM events e JOIN region r ON r.r_regionkey = e.user_id % 5 GROUP BY 1, 2""",
    "weather_request_correlation": """
WITH e AS (SELECT e.*, r.r_name FROM events e JOIN region r ON r.r_regionkey = e.user_id % 5),
req AS (SELECT upper(r_name) AS borough, CAST(ts AS DATE) AS day, count(*) AS n_req
        FROM e WHERE event_type <> 'view' GROUP BY 1, 2),
obs AS (SELECT upper(r_name) AS borough,
          CAST(timezone('America/New_York', date_trunc('second', ts) AT TIME ZONE 'UTC') AS DATE) AS day,
          avg(value) AS mean_temp
        FROM e WHERE event_type = 'view' GROUP BY 1, 2),
pb AS (SELECT req.borough, count(*) AS n_days, CAST(sum(req.n_req) AS BIGINT) AS requests,
         round(corr(CAST(req.n_req AS DOUBLE), obs.mean_temp), 6) AS corr_temp
       FROM req LEFT JOIN obs ON obs.borough = req.borough AND obs.day = req.day GROUP BY 1),
pc AS (
  SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS survey_year,
    count(*) FILTER (WHERE o_orderstatus = 'F') AS f
  FROM orders GROUP BY 1, 2),
d AS (
  SELECT upper(r.r_name) AS borough, pc.survey_year, CAST(count(*) AS DOUBLE) AS total_population,
    CAST(sum(pc.f) AS DOUBLE) AS below
  FROM pc JOIN customer c ON c.c_custkey = pc.o_custkey
  JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey
  GROUP BY 1, 2),
cur AS (SELECT borough, total_population,
          CASE WHEN total_population > 0 THEN CAST(printf('%.2f', below / total_population * 100) AS DOUBLE) END AS poverty_rate_pct
        FROM d QUALIFY row_number() OVER (PARTITION BY borough ORDER BY survey_year DESC) = 1)
SELECT pb.borough, pb.n_days, pb.requests, pb.corr_temp, cur.total_population, cur.poverty_rate_pct
FROM pb LEFT JOIN cur ON cur.borough = pb.borough""",
    "requests_typed": """
SELECT CAST(event_id AS VARCHAR) AS unique_key, date_trunc('millisecond', ts) AS created_at,
  CASE WHEN event_id % 3 = 0 THEN date_trunc('millisecond', ts + INTERVAL 1 HOUR) END AS closed_at,
  CAST(printf('%.2f', value) AS DOUBLE) AS latitude_d,
  CAST(printf('-%.2f', value) AS DOUBLE) AS longitude_d
FROM events""",
    "borough_normalise": """
SELECT r.r_name AS borough, count(*) AS n_requests
FROM events e JOIN region r ON r.r_regionkey = e.user_id % 5 GROUP BY 1""",
    "local_day": """
SELECT event_id, CAST(timezone('America/New_York', ts AT TIME ZONE 'UTC') AS DATE) AS local_day
FROM events""",
    "scd2_dimension": """
WITH x AS (
  SELECT user_id, event_type, ts, event_id,
    lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev,
    row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
  FROM events),
s AS (SELECT user_id, event_type, ts, event_id FROM x WHERE rn = 1 OR prev IS DISTINCT FROM event_type)
SELECT user_id, event_type, ts AS valid_from,
  lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to,
  lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL AS is_current
FROM s""",
    "census_dimension": """
WITH pc AS (
  SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS survey_year, count(*) AS n,
    max(o_totalprice) AS top, count(*) FILTER (WHERE o_orderstatus = 'F') AS f,
    count(*) FILTER (WHERE o_orderstatus = 'P') AS p
  FROM orders GROUP BY 1, 2),
d AS (
  SELECT r.r_name AS borough, pc.survey_year,
    CAST(count(*) AS DOUBLE) AS total_population, max(pc.top) AS median_household_income,
    CAST(sum(pc.f) AS DOUBLE) AS population_below_poverty,
    CAST(sum(pc.n) AS DOUBLE) AS total_housing_units,
    CAST(NULLIF(sum(pc.p), 0) AS DOUBLE) AS total_workers_commuting
  FROM pc JOIN customer c ON c.c_custkey = pc.o_custkey
  JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey
  GROUP BY 1, 2),
m AS (
  SELECT *, CASE WHEN total_population > 0 AND population_below_poverty IS NOT NULL
    THEN CAST(printf('%.2f', population_below_poverty / total_population * 100) AS DOUBLE) END AS poverty_rate_pct FROM d),
x AS (
  SELECT *, row_number() OVER w AS rn,
    lag(total_population) OVER w AS p1, lag(median_household_income) OVER w AS p2,
    lag(population_below_poverty) OVER w AS p3, lag(total_housing_units) OVER w AS p4,
    lag(total_workers_commuting) OVER w AS p5, lag(poverty_rate_pct) OVER w AS p6
  FROM m WINDOW w AS (PARTITION BY borough ORDER BY survey_year)),
s AS (
  SELECT * FROM x WHERE rn = 1 OR p1 IS DISTINCT FROM total_population
    OR p2 IS DISTINCT FROM median_household_income OR p3 IS DISTINCT FROM population_below_poverty
    OR p4 IS DISTINCT FROM total_housing_units OR p5 IS DISTINCT FROM total_workers_commuting
    OR p6 IS DISTINCT FROM poverty_rate_pct)
SELECT borough, total_population, median_household_income, population_below_poverty,
  total_housing_units, total_workers_commuting, poverty_rate_pct,
  survey_year AS valid_from_year,
  lead(survey_year) OVER (PARTITION BY borough ORDER BY survey_year) AS valid_to_year,
  lead(survey_year) OVER (PARTITION BY borough ORDER BY survey_year) IS NULL AS is_current
FROM s""",
    "yoy_change": """
WITH a AS (
  SELECT r.r_name AS region, CAST(year(o.o_orderdate) AS INTEGER) AS year, count(*) AS n_orders
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
  JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey
  GROUP BY 1, 2)
SELECT region, year, n_orders,
  lag(n_orders) OVER (PARTITION BY region ORDER BY year) AS prev_orders,
  n_orders - lag(n_orders) OVER (PARTITION BY region ORDER BY year) AS change
FROM a""",
    "density_proxy": """
WITH c AS (SELECT c_nationkey AS k, count(*) AS n FROM customer GROUP BY 1),
s AS (SELECT s_nationkey AS k, count(*) AS n FROM supplier GROUP BY 1)
SELECT n.n_nationkey, n.n_name, COALESCE(c.n, 0) AS n_customers, COALESCE(s.n, 0) AS n_suppliers,
  round(CAST(c.n AS DOUBLE) / NULLIF(s.n, 0), 4) AS density
FROM nation n LEFT JOIN c ON c.k = n.n_nationkey LEFT JOIN s ON s.k = n.n_nationkey""",
    "daily_volume": """
SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2""",
    "weather_correlation": """
WITH e AS (SELECT e.*, r.r_name FROM events e JOIN region r ON r.r_regionkey = e.user_id % 5),
req AS (SELECT upper(r_name) AS borough, CAST(ts AS DATE) AS day, count(*) AS n_req
        FROM e WHERE event_type <> 'view' GROUP BY 1, 2),
obs AS (SELECT upper(r_name) AS borough, CAST(ts AS DATE) AS day, avg(value) AS mean_temp
        FROM e WHERE event_type = 'view' GROUP BY 1, 2),
pb AS (SELECT req.borough, count(*) AS n_days, CAST(sum(req.n_req) AS BIGINT) AS requests,
         round(corr(CAST(req.n_req AS DOUBLE), obs.mean_temp), 6) AS corr_temp
       FROM req LEFT JOIN obs ON obs.borough = req.borough AND obs.day = req.day GROUP BY 1),
demo AS (SELECT upper(r.r_name) AS borough, count(*) AS population,
           CAST(printf('%.2f', CAST(count(*) FILTER (WHERE c.c_acctbal < 0) AS DOUBLE) / count(*) * 100) AS DOUBLE) AS low_rate
         FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
         JOIN region r ON r.r_regionkey = n.n_regionkey GROUP BY 1)
SELECT pb.borough, pb.n_days, pb.requests, pb.corr_temp, demo.population, demo.low_rate
FROM pb LEFT JOIN demo ON demo.borough = pb.borough""",
}
