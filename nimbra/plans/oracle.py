"""The registered queries in plain SQL, written apart from the Spark code.

The same arithmetic rules hold on both sides: sums over decimals, explicit
rounding, explicit order for ties.
"""

from __future__ import annotations

from nimbra import fixed_values as V

CITIES = """(VALUES
 (0,'mumbai','Mumbai','India',19.0760E0,72.8777E0,'Asia/Kolkata',330),
 (1,'delhi','Delhi','India',28.6139E0,77.2090E0,'Asia/Kolkata',330),
 (2,'bangalore','Bangalore','India',12.9716E0,77.5946E0,'Asia/Kolkata',330),
 (3,'london','London','UK',51.5074E0,-0.1278E0,'Europe/London',0),
 (4,'new_york','New York','USA',40.7128E0,-74.0060E0,'America/New_York',-300),
 (5,'tokyo','Tokyo','Japan',35.6762E0,139.6503E0,'Asia/Tokyo',540)
) AS c(ci,city_name,city_display_name,country,latitude,longitude,timezone,utc_minutes)"""

# utc_minutes above is the winter offset; the events all fall in January.

SILVER_COLUMNS = (
    "city_name, city_display_name, country, latitude, longitude, observation_timestamp, "
    "observation_date, observation_hour, timezone, temperature_2m, apparent_temperature, "
    "relative_humidity_2m, precipitation, rain, wind_speed_10m, wind_direction_10m, "
    "weather_code, weather_condition, uv_index, ingestion_timestamp, pipeline_run_date, "
    "data_quality_flag"
)
MEASURES = (
    "temperature_2m, relative_humidity_2m, apparent_temperature, precipitation, rain, "
    "wind_speed_10m, wind_direction_10m, weather_code, uv_index"
)
GOLD_MEASURES = [
    "avg_temperature", "max_temperature", "min_temperature", "avg_apparent_temperature",
    "avg_humidity", "max_humidity", "min_humidity", "total_precipitation", "total_rain",
    "had_rain", "avg_wind_speed", "max_wind_speed", "dominant_wind_direction",
    "dominant_condition", "dominant_weather_code", "max_uv_index", "avg_uv_index",
    "temperature_range", "comfort_score",
]
EVENT_VALUES = [
    "severity", "max_temperature", "min_temperature", "total_precipitation",
    "max_wind_speed", "max_uv_index", "dominant_condition",
]

CONDITION = (
    "CASE "
    + " ".join(
        f"WHEN weather_code IN ({', '.join(map(str, codes))}) THEN '{label}'"
        for label, codes in V.WEATHER_CONDITIONS
    )
    + f" ELSE '{V.UNKNOWN_CONDITION}' END"
)
FLAG = (
    f"CASE WHEN {' OR '.join(f'{c} IS NULL' for c in V.PLAUSIBLE)} THEN 'BAD' WHEN "
    + " OR ".join(f"{c} NOT BETWEEN {low} AND {high}" for c, (low, high) in V.PLAUSIBLE.items())
    + " THEN 'SUSPECT' ELSE 'GOOD' END"
)
EVENT_TESTS = {
    "EXTREME_HEAT": f"max_temperature > {V.HEAT_ABOVE}",
    "EXTREME_COLD": f"min_temperature < {V.COLD_BELOW}",
    "HEAVY_RAIN": f"total_precipitation > {V.RAIN_ABOVE}",
    "STRONG_WIND": f"max_wind_speed > {V.WIND_ABOVE}",
    "HIGH_UV": f"max_uv_index > {V.UV_ABOVE}",
    "THUNDERSTORM": f"dominant_weather_code IN ({', '.join(map(str, V.STORM_CODES))})",
}
EVENT_TYPE = "CASE " + " ".join(f"WHEN {t} THEN '{n}'" for n, t in EVENT_TESTS.items()) + " END"
# Severity levels by temperature, precipitation and wind.
SEVERITY = """CASE
  WHEN max_temperature > 48 OR total_precipitation > 100 OR max_wind_speed > 120 THEN 'CRITICAL'
  WHEN max_temperature > 45 OR total_precipitation > 75 OR max_wind_speed > 90 THEN 'WARNING'
  ELSE 'WATCH' END"""


def rounded(x: str, digits: int) -> str:
    scale = 10**digits
    return (
        f"(CASE WHEN ({x}) < 0 THEN -CAST(FLOOR(-({x})*{scale} + 0.5E0) AS BIGINT) "
        f"ELSE CAST(FLOOR(({x})*{scale} + 0.5E0) AS BIGINT) END / CAST({scale} AS DOUBLE))"
    )


def total(x: str, over: str = "") -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(28,10))){over} AS DOUBLE)"


def mean(x: str, over: str = "") -> str:
    return f"({total(x, over)} / NULLIF(COUNT({x}){over}, 0))"


def readings(table: str = "events", documents: bool = False) -> str:
    """CTEs up to ``r``: readings with their city, date, document and position."""
    if documents:
        rows = """SELECT *, (hour_index-1)%24 AS hour FROM (SELECT event_id, event_type,
  CAST(user_id % 6 AS INT) AS ci, CAST(ts AS DATE) AS d, CAST(EXTRACT(DAY FROM ts) AS INT) AS dom,
  event_id // 256 AS document, CAST(ROW_NUMBER() OVER (PARTITION BY user_id % 6, CAST(ts AS DATE),
    event_id // 256 ORDER BY ts, event_id) AS INT) AS hour_index FROM events) q"""
    elif table == "events":
        rows = """SELECT event_id, event_type, CAST(user_id % 6 AS INT) AS ci, CAST(ts AS DATE) AS d,
  CAST(EXTRACT(DAY FROM ts) AS INT) AS dom, 0 AS document, 0 AS hour_index,
  CAST(EXTRACT(HOUR FROM ts) AS INT) AS hour FROM events"""
    else:
        rows = """SELECT CAST(l_orderkey*7+l_partkey+l_linenumber AS BIGINT) AS event_id,
  CASE WHEN l_returnflag='R' THEN 'error' ELSE 'view' END AS event_type,
  CAST(l_suppkey % 6 AS INT) AS ci, CAST(l_shipdate AS DATE) AS d,
  CAST(EXTRACT(DAY FROM l_shipdate) AS INT) AS dom, 0 AS document, 0 AS hour_index,
  CAST((l_orderkey*7+l_linenumber)%24 AS INT) AS hour FROM lineitem"""
    return f"""WITH e AS ({rows}),
b AS (SELECT *, (ci*131+dom*17)%60-8 AS base FROM e),
r AS (SELECT c.city_name, c.city_display_name, c.country, c.latitude, c.longitude, c.timezone,
  c.utc_minutes, b.d, b.hour_index, b.document, b.event_id,
  concat(CAST(b.d AS VARCHAR),'T',lpad(CAST(b.hour AS VARCHAR),2,'0'),':00') AS raw_timestamp,
  concat(CAST(CAST(b.d + INTERVAL 1 DAY AS DATE) AS VARCHAR),'T00:05:00') AS ingestion_text,
  CASE WHEN event_id%97=0 THEN NULL WHEN event_id%397=1 THEN CAST(75 AS DOUBLE) ELSE CAST(base*10+event_id%50 AS DOUBLE)/10 END AS temperature_2m,
  CAST(base*10+event_id%70-15 AS DOUBLE)/10 AS apparent_temperature,
  CAST(CASE WHEN event_id%199=0 THEN NULL WHEN event_id%211=1 THEN 105 ELSE 20+(event_id*7)%79 END AS INT) AS relative_humidity_2m,
  CASE WHEN event_type='error' AND (b.ci+dom)%3=0 THEN CAST((event_id%90)*((b.ci+2*dom)%7) AS DOUBLE)/10 ELSE CAST(0 AS DOUBLE) END AS precipitation,
  CASE WHEN base>=0 AND event_type='error' AND (b.ci+dom)%3=0 THEN CAST((event_id%90)*((b.ci+2*dom)%7) AS DOUBLE)/10 ELSE CAST(0 AS DOUBLE) END AS rain,
  CAST(50+event_id%200+CASE WHEN (b.ci*5+dom)%9=0 THEN (dom*130)%1100 ELSE 0 END AS DOUBLE)/10 AS wind_speed_10m,
  CAST((event_id*53%16)*22 AS INT) AS wind_direction_10m,
  CAST(CASE (b.ci*3+dom*5)%14+CASE WHEN event_id%4=0 THEN 1 ELSE 0 END WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 3 WHEN 4 THEN 45 WHEN 5 THEN 51 WHEN 6 THEN 61 WHEN 7 THEN 63 WHEN 8 THEN 71 WHEN 9 THEN 77 WHEN 10 THEN 80 WHEN 11 THEN 85 WHEN 12 THEN 95 WHEN 13 THEN 96 ELSE 100 END AS INT) AS weather_code,
  CAST(((event_id%5)+((b.ci*7+dom*3)%7))*10 AS DOUBLE)/10 AS uv_index
  FROM b JOIN {CITIES} ON b.ci=c.ci)"""


def silver(name: str = "s", source: str = "r") -> str:
    """CTEs ``f<name>`` (every reading, flagged) and ``<name>`` (without BAD)."""
    return f""", f{name} AS (SELECT city_name, city_display_name, country, latitude, longitude,
  CAST(raw_timestamp AS TIMESTAMP) AS observation_timestamp,
  CAST(CAST(raw_timestamp AS TIMESTAMP) AS DATE) AS observation_date,
  CAST(EXTRACT(HOUR FROM CAST(raw_timestamp AS TIMESTAMP)) AS INT) AS observation_hour,
  timezone, {MEASURES},
  {CONDITION} AS weather_condition,
  CAST(ingestion_text AS TIMESTAMP) AS ingestion_timestamp, d AS pipeline_run_date,
  {FLAG} AS data_quality_flag,
  hour_index, document, utc_minutes
  FROM {source}),
{name} AS (SELECT * FROM f{name} WHERE data_quality_flag <> 'BAD')"""


def gold(name: str = "g", source: str = "s", as_of: str = "2024-02-01") -> str:
    t, h = mean("temperature_2m"), "(CAST(SUM(relative_humidity_2m) AS DOUBLE)/COUNT(relative_humidity_2m))"
    comfort = rounded("100.0E0 - ABS(mean_t - 22)*2 - ABS(mean_h - 50)*0.3E0", 2)
    key = "city_name, observation_date"
    return f""", {name}c AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY {key} ORDER BY n DESC, weather_condition) AS place
  FROM (SELECT {key}, weather_condition, COUNT(*) AS n, MIN(weather_code) AS code FROM {source} GROUP BY ALL) q),
{name}w AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY {key} ORDER BY n DESC, wind_direction_10m) AS place
  FROM (SELECT {key}, wind_direction_10m, COUNT(*) AS n FROM {source}
    WHERE wind_direction_10m IS NOT NULL GROUP BY ALL) q),
{name}a AS (SELECT {key}, city_display_name, country, {t} AS mean_t, {h} AS mean_h,
  MAX(temperature_2m) AS hi, MIN(temperature_2m) AS lo, {mean("apparent_temperature")} AS mean_a,
  MAX(relative_humidity_2m) AS max_humidity, MIN(relative_humidity_2m) AS min_humidity,
  {total("precipitation")} AS precip, {total("rain")} AS rain, {mean("wind_speed_10m")} AS mean_w,
  MAX(wind_speed_10m) AS wind, MAX(uv_index) AS uv, {mean("uv_index")} AS mean_uv,
  CAST(COUNT(*) AS INT) AS record_count FROM {source} GROUP BY ALL),
{name} AS (SELECT a.city_name, city_display_name, country, a.observation_date AS weather_date,
  {rounded("mean_t", 2)} AS avg_temperature, {rounded("hi", 2)} AS max_temperature,
  {rounded("lo", 2)} AS min_temperature, {rounded("mean_a", 2)} AS avg_apparent_temperature,
  {rounded("mean_h", 2)} AS avg_humidity, max_humidity, min_humidity,
  {rounded("precip", 2)} AS total_precipitation, {rounded("rain", 2)} AS total_rain,
  COALESCE(precip > 0, FALSE) AS had_rain,
  {rounded("mean_w", 2)} AS avg_wind_speed, {rounded("wind", 2)} AS max_wind_speed,
  w.wind_direction_10m AS dominant_wind_direction, c.weather_condition AS dominant_condition,
  c.code AS dominant_weather_code, {rounded("uv", 2)} AS max_uv_index,
  {rounded("mean_uv", 2)} AS avg_uv_index, {rounded("hi - lo", 2)} AS temperature_range,
  CASE WHEN mean_t IS NULL OR mean_h IS NULL THEN NULL
    ELSE GREATEST(0.0E0, LEAST(100.0E0, {comfort})) END AS comfort_score,
  DATE '{as_of}' AS first_seen_date, DATE '{as_of}' AS last_updated_date,
  a.observation_date AS pipeline_run_date, record_count
  FROM {name}a a JOIN {name}c c ON a.city_name=c.city_name AND a.observation_date=c.observation_date AND c.place=1
  LEFT JOIN {name}w w ON a.city_name=w.city_name AND a.observation_date=w.observation_date AND w.place=1)"""


def events(name: str = "x", source: str = "g", as_of: str = "2024-02-01") -> str:
    return f""", {name} AS (SELECT city_name, city_display_name, country, weather_date AS event_date,
  {EVENT_TYPE} AS event_type, {SEVERITY} AS severity,
  max_temperature, min_temperature, total_precipitation, max_wind_speed, max_uv_index,
  dominant_condition, DATE '{as_of}' AS detected_on, weather_date AS pipeline_run_date
  FROM {source} WHERE {" OR ".join(EVENT_TESTS.values())})"""


def merged_daily(target: str, source: str) -> str:
    sticky = ["city_display_name", "country", "first_seen_date"]
    updated = [*GOLD_MEASURES, "last_updated_date", "pipeline_run_date", "record_count"]
    columns = [f"CASE WHEN t.city_name IS NOT NULL THEN t.{c} ELSE s.{c} END AS {c}" for c in sticky]
    columns += [f"CASE WHEN s.city_name IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}" for c in updated]
    return f"""SELECT COALESCE(t.city_name, s.city_name) AS city_name,
  COALESCE(t.weather_date, s.weather_date) AS weather_date, {", ".join(columns)}
  FROM {target} t FULL OUTER JOIN {source} s
  ON t.city_name = s.city_name AND t.weather_date = s.weather_date"""


def merged_events(target: str, source: str, keep: str = "TRUE") -> str:
    sticky = ["city_display_name", "country", "detected_on"]
    updated = [*EVENT_VALUES, "pipeline_run_date"]
    columns = [f"CASE WHEN t.city_name IS NOT NULL THEN t.{c} ELSE s.{c} END AS {c}" for c in sticky]
    columns += [f"CASE WHEN s.city_name IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}" for c in updated]
    keys = ["city_name", "event_date", "event_type"]
    return f"""SELECT {", ".join(f"COALESCE(t.{k}, s.{k}) AS {k}" for k in keys)}, {", ".join(columns)}
  FROM {target} t FULL OUTER JOIN {source} s ON {" AND ".join(f"t.{k} = s.{k}" for k in keys)}
  WHERE s.city_name IS NOT NULL OR {keep}"""


def temp_trend(as_of: str, calendar: bool = False) -> str:
    if calendar:
        order = "OVER (PARTITION BY city_name ORDER BY weather_date RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)"
        before = "MAX(avg_temperature) OVER (PARTITION BY city_name ORDER BY weather_date RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING)"
    else:
        order = "OVER (PARTITION BY city_name ORDER BY weather_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"
        before = "LAG(avg_temperature, 1) OVER (PARTITION BY city_name ORDER BY weather_date)"
    return f"""SELECT city_display_name, country, weather_date, avg_temperature, max_temperature,
  min_temperature, temperature_range, comfort_score, dominant_condition,
  {rounded("rolling", 2)} AS rolling_7day_avg_temp,
  {rounded("avg_temperature - before", 2)} AS temp_change_from_yesterday, heat_rank_that_day
FROM (SELECT *, {mean("avg_temperature", " " + order)} AS rolling, {before} AS before,
  CAST(RANK() OVER (PARTITION BY weather_date ORDER BY avg_temperature DESC) AS INT) AS heat_rank_that_day
  FROM g WHERE weather_date >= DATE '{as_of}' - INTERVAL 30 DAY) q"""


def rainiest_cities(as_of: str) -> str:
    return f"""SELECT city_display_name, country, {rounded("p", 2)} AS total_precipitation_mm,
  {rounded("r", 2)} AS total_rain_mm, rainy_days, total_days,
  {rounded("rainy_days * 100.0E0 / total_days", 1)} AS rainy_day_percentage,
  {rounded("p / NULLIF(rainy_days, 0)", 2)} AS avg_rain_per_rainy_day_mm, max_single_day_rain_mm,
  CAST(RANK() OVER (ORDER BY p DESC) AS INT) AS rain_rank, {rounded("comfort", 1)} AS avg_comfort_score
FROM (SELECT city_name, city_display_name, country, {total("total_precipitation")} AS p,
  {total("total_rain")} AS r, COUNT(CASE WHEN had_rain THEN 1 END) AS rainy_days,
  COUNT(*) AS total_days, MAX(total_precipitation) AS max_single_day_rain_mm,
  {mean("comfort_score")} AS comfort FROM g
  WHERE weather_date >= DATE_TRUNC('month', DATE '{as_of}') AND weather_date < DATE '{as_of}'
  GROUP BY city_name, city_display_name, country) q"""


def extreme_summary(as_of: str) -> str:
    by_type = ", ".join(
        f"COUNT(*) FILTER (event_type = '{t}') AS {t.lower().removeprefix('extreme_')}_events"
        for t in EVENT_TESTS
    )
    weights = {**{level: w for level, *_, w in V.SEVERITIES}, V.LOWEST_SEVERITY[0]: V.LOWEST_SEVERITY[1]}
    by_level = ", ".join(f"COUNT(*) FILTER (severity = '{s}') AS {s.lower()}_events" for s in weights)
    risk = " + ".join(f"{w} * COUNT(*) FILTER (severity = '{s}')" for s, w in weights.items())
    return f""", n AS (SELECT city_name, event_type, COUNT(*) AS event_count FROM x GROUP BY ALL),
j AS (SELECT x.*, n.event_count, ROW_NUMBER() OVER (PARTITION BY x.city_name, x.city_display_name, x.country
    ORDER BY n.event_count DESC, x.event_type DESC) AS place
  FROM x JOIN n ON x.city_name=n.city_name AND x.event_type=n.event_type
  WHERE event_date >= DATE '{as_of}' - INTERVAL 90 DAY)
SELECT 'CITY_SUMMARY' AS report_section, city_display_name, country, COUNT(*) AS total_extreme_events,
  {by_type}, {by_level}, MAX(event_date) AS most_recent_event,
  MAX(CASE WHEN place = 1 THEN event_type END) AS most_common_event_type,
  {risk} AS risk_score
FROM j GROUP BY city_name, city_display_name, country"""


def extreme_timeline(as_of: str) -> str:
    return f"""SELECT 'EVENT_TIMELINE' AS report_section, event_date, city_display_name, country,
  event_type, {", ".join(EVENT_VALUES)} FROM x WHERE event_date >= DATE '{as_of}' - INTERVAL 30 DAY"""


def changed(name: str, source: str, **columns: str) -> str:
    """CTE ``name``: ``source`` with some columns computed anew."""
    replaced = ", ".join(f"{expression} AS {column}" for column, expression in columns.items())
    return f", {name} AS (SELECT * REPLACE ({replaced}) FROM {source})"
