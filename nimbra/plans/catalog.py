"""Registered queries on the provided tables, each beside its SQL."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbra.fixed_values import CITIES, HOURLY_VARIABLES
from nimbra.operators import gates, shape
from nimbra.operators import silver as silver_ops
from nimbra.operators import upsert
from nimbra.operators.daily import KEYS as DAILY_KEYS
from nimbra.operators.daily import (
    condition_counts,
    dominant_wind,
    partial_summaries,
    summary_of_partials,
    to_daily,
    wind_sketches,
)
from nimbra.operators.events import to_events, to_events_multilabel
from nimbra.plans import oracle as sql
from nimbra.plans import reports
from nimbra.plans.runs import (
    Lakehouse,
    run_backfill,
    run_daily,
    run_range,
    run_silver,
    store_partials,
    store_silver,
    upsert_daily,
    upsert_events,
    written,
)
from nimbra.scratch import new_folder
from nimbra.schemas import BRONZE, BRONZE_PARTITIONS
from nimbra.session import configure
from nimbra.sources.bronze import (
    good_documents,
    in_date_range,
    landed_files,
    malformed_documents,
    read_bronze,
    register_bronze,
    write_bronze,
)
from nimbra.sources.cities import configuration_text, configured_cities, read_cities
from nimbra.sources.readings import document_readings, hourly_readings
from nimbra.streaming.ingest import stream_daily, stream_quarantine as quarantine_of_stream

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

AS_OF = dt.date(2024, 2, 1)


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(configure(spark), sf_dir)

        QUERIES[function.__name__] = run
        if oracle:
            ORACLES[function.__name__] = oracle
        return run

    return register


# --- inputs shared by the queries -------------------------------------------

HOURLY = sql.readings()
DOCUMENTS = sql.readings(documents=True)
SILVER = HOURLY + sql.silver()
GOLD = SILVER + sql.gold()
EVENTS = GOLD + sql.events()
LINES = sql.readings("lineitem") + sql.silver()
LINES_GOLD = LINES + sql.gold()
LINES_EVENTS = LINES_GOLD + sql.events()

DOCUMENT_KEYS = [*silver_ops.METADATA, "document"]


def silver_of(spark: SparkSession, sf_dir: str, table: str = "events") -> DataFrame:
    return silver_ops.to_silver(hourly_readings(spark, sf_dir, table))


def daily_of(spark: SparkSession, sf_dir: str, table: str = "events") -> DataFrame:
    return to_daily(silver_of(spark, sf_dir, table), AS_OF)


def events_of(spark: SparkSession, sf_dir: str, table: str = "events") -> DataFrame:
    return to_events(daily_of(spark, sf_dir, table), AS_OF)


def as_documents(gathered: DataFrame) -> DataFrame:
    """Gathered series as whole Bronze documents."""
    units = F.struct(F.lit("iso8601").alias("time"), *[
        F.lit(None).cast("string").alias(v) for v in HOURLY_VARIABLES
    ])
    filled = {
        "generationtime_ms": F.lit(None).cast("double"),
        "utc_offset_seconds": F.lit(None).cast("int"),
        "timezone_abbreviation": F.lit(None).cast("string"),
        "elevation": F.lit(None).cast("double"),
        "hourly_units": units,
    }
    return gathered.withColumns(filled)


def documents_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze documents holding every event, with their partition keys."""
    gathered = shape.collect_documents(
        document_readings(spark, sf_dir), DOCUMENT_KEYS, "hour_index"
    )
    return shape.with_partition_keys(as_documents(gathered))


def responses_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed responses: one city, the days of 1024 consecutive event ids."""
    rows = document_readings(spark, sf_dir).withColumns(
        {
            "response": F.floor(F.col("document") / 4),
            "at": F.struct("pipeline_run_date", "document", "hour_index"),
        }
    )
    keys = ["city_name", "city_display_name", "country", "latitude", "longitude", "timezone"]
    return as_documents(shape.collect_documents(rows, [*keys, "response"], "at"))


def landed(spark: SparkSession, documents: DataFrame) -> str:
    root = new_folder(spark, "bronze")
    write_bronze(documents, root)
    return root


def positions_of(documents: DataFrame, *carried: str | Column) -> DataFrame:
    """Every position of every document, however long."""
    return documents.select(
        *carried, "hourly", F.posexplode("hourly.time").alias("position", "raw_timestamp")
    ).select(
        "*", *[F.get(f"hourly.{v}", F.col("position")).alias(v) for v in HOURLY_VARIABLES]
    ).drop("hourly")


# --- Bronze: scans and sinks ---------------------------------------------------

PARTITION_SQL = """city_name AS city, strftime(d, '%Y') AS year, strftime(d, '%m') AS month,
  strftime(d, '%d') AS day"""


@query(f"""{DOCUMENTS} SELECT {PARTITION_SQL}, city_name, city_display_name, country, latitude,
  longitude, timezone, ingestion_text AS ingestion_timestamp,
  CAST(d AS VARCHAR) AS pipeline_run_date, hour_index - 1 AS position, raw_timestamp, {sql.MEASURES} FROM r""")
def bronze_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = good_documents(read_bronze(spark, landed(spark, documents_of(spark, sf_dir))))
    return positions_of(bronze, *BRONZE_PARTITIONS, *silver_ops.METADATA)


@query(f"""{DOCUMENTS} SELECT city, year, month, day,
  COUNT(CASE WHEN document % 7 <> 3 THEN 1 END) AS good_documents,
  COUNT(CASE WHEN document % 7 = 3 THEN 1 END) AS malformed_documents
FROM (SELECT DISTINCT {PARTITION_SQL}, document FROM r) q GROUP BY ALL""")
def bronze_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some documents of the landing are cut off in the middle."""
    bronze = read_bronze(spark, landed_broken(spark, sf_dir))
    good = good_documents(bronze).select(*BRONZE_PARTITIONS, F.lit(1).alias("good"))
    bad = malformed_documents(bronze).select(*BRONZE_PARTITIONS, F.lit(0).alias("good"))
    return good.unionByName(bad).groupBy(*BRONZE_PARTITIONS).agg(
        F.count_if(F.col("good") == 1).alias("good_documents"),
        F.count_if(F.col("good") == 0).alias("malformed_documents"),
    )


def landed_broken(spark: SparkSession, sf_dir: str, whole: bool = False) -> str:
    """A landing in which every seventh document is cut off in the middle, and landed
    ``whole`` as well if asked for."""
    text = F.to_json(F.struct(*[f.name for f in BRONZE.fields]))
    cut = F.left(text, F.length(text) / 2)
    lines = F.array(cut, text) if whole else F.array(cut)
    line = F.explode(F.when(F.col("document") % 7 == 3, lines).otherwise(F.array(text)))
    root = new_folder(spark, "bronze")
    (
        documents_of(spark, sf_dir)
        .select(*BRONZE_PARTITIONS, line.alias("value"))
        .write.partitionBy(*BRONZE_PARTITIONS)
        .text(root)
    )
    return root


@query(f"""{DOCUMENTS} SELECT city, year, month, day, COUNT(*) AS documents
FROM (SELECT DISTINCT {PARTITION_SQL}, document FROM r) q GROUP BY ALL""")
def bronze_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the landing arrives later: a new read sees the new folders."""
    documents = documents_of(spark, sf_dir)
    early = F.col("day") <= "15"
    root = landed(spark, documents.where(early))
    write_bronze(documents.where(~early), root)
    bronze = good_documents(read_bronze(spark, root))
    return bronze.groupBy(*BRONZE_PARTITIONS).agg(F.count("*").alias("documents"))


@query(f"""{DOCUMENTS} SELECT {PARTITION_SQL}, d AS run_date, raw_timestamp, temperature_2m,
  relative_humidity_2m, CASE WHEN city_name = 'london' THEN uv_index + 1 ELSE uv_index END AS uv_index FROM r""")
def bronze_write_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One city's days are landed again with other values; the rest stays."""
    documents = documents_of(spark, sf_dir)
    root = landed(spark, documents)
    raised = F.transform("hourly.uv_index", lambda v: v + 1)
    restated = documents.where(F.col("city") == "london").withColumn(
        "hourly", F.col("hourly").withField("uv_index", raised)
    )
    write_bronze(restated, root)
    bronze = good_documents(read_bronze(spark, root))
    run_date = F.col("pipeline_run_date").cast("date").alias("run_date")
    return positions_of(bronze, *BRONZE_PARTITIONS, run_date).select(
        *BRONZE_PARTITIONS, "run_date", "raw_timestamp", "temperature_2m",
        "relative_humidity_2m", "uv_index",
    )


@query(f"""{DOCUMENTS} SELECT city_name, raw_timestamp, temperature_2m, wind_speed_10m
FROM r WHERE city_name = 'london' AND d BETWEEN DATE '2024-01-08' AND DATE '2024-01-21'""")
def bronze_partition_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One city, two weeks; only two variables are parsed from its files."""
    root = landed(spark, documents_of(spark, sf_dir))
    wanted = (F.col("city") == "london") & in_date_range(dt.date(2024, 1, 8), dt.date(2024, 1, 21))
    bronze = good_documents(
        read_bronze(spark, root, variables=["temperature_2m", "wind_speed_10m"]).where(wanted)
    )
    hours = F.posexplode("hourly.time").alias("position", "raw_timestamp")
    return bronze.select("city_name", "hourly", hours).select(
        "city_name", "raw_timestamp",
        F.get("hourly.temperature_2m", F.col("position")).alias("temperature_2m"),
        F.get("hourly.wind_speed_10m", F.col("position")).alias("wind_speed_10m"),
    )


@query(f"""SELECT c.city_name AS name, city_display_name AS display_name, latitude, longitude,
  timezone, country, n AS readings, first_date, last_date
FROM {sql.CITIES} LEFT JOIN (SELECT CAST(user_id % 6 AS INT) AS ci, COUNT(*) AS n,
  CAST(MIN(ts) AS DATE) AS first_date, CAST(MAX(ts) AS DATE) AS last_date FROM events GROUP BY ALL) q
  ON c.ci = q.ci""")
def city_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cities from a configuration document, with what the events hold of each."""
    path = new_folder(spark, "config")
    spark.range(1).select(F.lit(configuration_text()).alias("value")).coalesce(1).write.text(path)
    names = F.array(*[F.lit(c["name"]) for c in CITIES])
    city = F.get(names, (F.col("user_id") % len(CITIES)).cast("int"))
    held = spark.read.parquet(f"{sf_dir}/events.parquet").groupBy(city.alias("name")).agg(
        F.count("*").alias("readings"),
        F.min("ts").cast("date").alias("first_date"),
        F.max("ts").cast("date").alias("last_date"),
    )
    return read_cities(spark, path).join(held, "name", "left")


# --- Bronze: shaping -----------------------------------------------------------

RESPONSE_POSITION = """ROW_NUMBER() OVER (PARTITION BY city_name, document // 4{day}
  ORDER BY d, document, hour_index) - 1"""


@query(f"""{DOCUMENTS} SELECT city_name, CAST(d AS VARCHAR) AS pipeline_run_date,
  document // 4 AS response, {PARTITION_SQL},
  CAST({RESPONSE_POSITION.format(day=", d")} AS INT) AS position, raw_timestamp, {sql.MEASURES} FROM r""")
def bronze_split_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = shape.split_daily(responses_of(spark, sf_dir))
    return positions_of(split, "city_name", "pipeline_run_date", "response", *BRONZE_PARTITIONS)


@query(f"""{DOCUMENTS}, p AS (SELECT *, document // 4 AS response,
  MAX(d) OVER (PARTITION BY city_name, document // 4) AS run_date FROM r)
SELECT city_name, response, CAST(run_date AS VARCHAR) AS pipeline_run_date,
  CAST(ROW_NUMBER() OVER (PARTITION BY city_name, response ORDER BY document, hour_index) - 1 AS INT) AS position,
  raw_timestamp, {sql.MEASURES} FROM p WHERE d = run_date""")
def bronze_filter_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each response cut to its latest local date."""
    latest = F.array_max(F.transform("hourly.time", lambda t: F.substring(t, 1, 10)))
    kept = shape.keep_date(responses_of(spark, sf_dir), latest)
    return positions_of(kept, "city_name", "response", "pipeline_run_date")


@query(f"""{DOCUMENTS} SELECT city_name AS city, city_name, city_display_name, country,
  document // 4 AS response, '2024-02-01T06:00:00' AS ingestion_timestamp, COUNT(*) AS hours
FROM r GROUP BY ALL""")
def bronze_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    bare = responses_of(spark, sf_dir).withColumn("city", F.col("city_name")).drop(
        "city_name", "city_display_name", "country"
    )
    enriched = shape.attach_metadata(
        bare, configured_cities(spark), F.lit("2024-02-01T06:00:00")
    )
    return enriched.select(
        "city", "city_name", "city_display_name", "country", "response", "ingestion_timestamp",
        F.size("hourly.time").cast("bigint").alias("hours"),
    )


@query(f"""{DOCUMENTS} SELECT city_name, raw_timestamp, temperature_2m, wind_direction_10m,
  CASE WHEN document % 3 = 0 THEN NULL ELSE uv_index END AS uv_index
FROM r""")
def bronze_missing_variable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A variable is absent from some landed documents; their readings stay."""
    absent = F.col("document") % 3 == 0
    uv = F.when(~absent, F.col("hourly.uv_index"))
    documents = documents_of(spark, sf_dir).withColumn(
        "hourly", F.col("hourly").withField("uv_index", uv)
    )
    bronze = good_documents(read_bronze(spark, landed(spark, documents)))
    return silver_ops.explode_hours(bronze).select(
        "city_name", "raw_timestamp", "temperature_2m", "wind_direction_10m", "uv_index"
    )


@query(f"""{DOCUMENTS} SELECT DISTINCT city_name, CAST(d AS VARCHAR) AS pipeline_run_date, document
FROM r WHERE document % 5 = 2""")
def dq_missing_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without their hourly block are found, not passed on as empty."""
    documents = documents_of(spark, sf_dir)
    whole = F.when(F.col("document") % 5 != 2, F.col("hourly"))
    return shape.missing_hourly(documents.withColumn("hourly", whole)).select(
        "city_name", "pipeline_run_date", "document"
    )


@query(f"""{DOCUMENTS} SELECT city_name, CAST(d AS VARCHAR) AS pipeline_run_date, document,
  COUNT(*) AS hours FROM r GROUP BY ALL HAVING COUNT(*) <> 24""")
def dq_hour_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.hour_count_off(documents_of(spark, sf_dir)).select(
        "city_name", "pipeline_run_date", "document", F.col("hours").cast("bigint").alias("hours")
    )


@query(f"""{LINES_GOLD} SELECT city_name, weather_date, record_count FROM g WHERE record_count < 24""")
def dq_incomplete_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.incomplete_days(daily_of(spark, sf_dir, "lineitem"))


@query(f"""{DOCUMENTS} SELECT city_name, CAST(d AS VARCHAR) AS pipeline_run_date, document,
  COUNT(*) AS hours, MIN(CASE WHEN hour_index = 1 THEN raw_timestamp END) AS first_time,
  string_agg(COALESCE(CAST(CAST(ROUND(temperature_2m * 10) AS INT) AS VARCHAR), '-'), ',' ORDER BY hour_index) AS temperature_tenths,
  string_agg(CAST(wind_direction_10m AS VARCHAR), ',' ORDER BY hour_index) AS directions
FROM r GROUP BY ALL""")
def bronze_collect(spark: SparkSession, sf_dir: str) -> DataFrame:
    def text(series: str, value: Callable[[Column], Column]) -> Column:
        return F.array_join(F.transform(series, lambda v: value(v).cast("string")), ",", "-")

    return documents_of(spark, sf_dir).select(
        "city_name", "pipeline_run_date", "document",
        F.size("hourly.time").cast("bigint").alias("hours"),
        F.get("hourly.time", F.lit(0)).alias("first_time"),
        text("hourly.temperature_2m", lambda v: F.round(v * 10).cast("int")).alias(
            "temperature_tenths"
        ),
        text("hourly.wind_direction_10m", lambda v: v).alias("directions"),
    )


# --- Silver ----------------------------------------------------------------------


@query(f"""{DOCUMENTS} SELECT city_name, document, hour_index - 1 AS position, raw_timestamp,
  {sql.MEASURES} FROM r""")
def silver_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_ops.explode_hours(documents_of(spark, sf_dir), "document").select(
        "city_name", "document", "position", "raw_timestamp", *HOURLY_VARIABLES
    )


@query(f"{SILVER} SELECT {sql.SILVER_COLUMNS} FROM s")
def silver_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_of(spark, sf_dir)


@query(f"{DOCUMENTS + sql.silver()} SELECT {sql.SILVER_COLUMNS} FROM s")
def silver_from_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event, landed as JSON documents and read back."""
    bronze = good_documents(read_bronze(spark, landed(spark, documents_of(spark, sf_dir))))
    return silver_ops.to_silver(silver_ops.explode_hours(bronze))


@query(f"{LINES} SELECT {sql.SILVER_COLUMNS} FROM s")
def silver_hourly_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_of(spark, sf_dir, "lineitem")


@query(f"""{SILVER} SELECT city_name, raw_timestamp, observation_timestamp, observation_date,
  observation_hour FROM fs JOIN (SELECT DISTINCT raw_timestamp FROM r) q
  ON CAST(raw_timestamp AS TIMESTAMP) = observation_timestamp""")
def silver_time_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_ops.time_parts(hourly_readings(spark, sf_dir)).select(
        "city_name", "raw_timestamp", "observation_timestamp", "observation_date",
        "observation_hour",
    )


@query(f"{SILVER} SELECT city_name, observation_timestamp, weather_code, weather_condition FROM fs")
def silver_condition_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_ops.flagged(hourly_readings(spark, sf_dir)).select(
        "city_name", "observation_timestamp", "weather_code", "weather_condition"
    )


@query(f"""{SILVER} SELECT city_name, observation_timestamp, temperature_2m, relative_humidity_2m,
  wind_speed_10m, data_quality_flag FROM fs""")
def silver_quality_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_ops.flagged(hourly_readings(spark, sf_dir)).select(
        "city_name", "observation_timestamp", "temperature_2m", "relative_humidity_2m",
        "wind_speed_10m", "data_quality_flag",
    )


@query(f"""{SILVER} SELECT * REPLACE (CASE WHEN city_name = 'london' THEN uv_index + 1
  ELSE uv_index END AS uv_index) FROM (SELECT {sql.SILVER_COLUMNS} FROM s) q""")
def silver_replace_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One city restated, twice: its rows are replaced, other cities keep theirs."""
    lake = Lakehouse.at(new_folder(spark, "lake"))
    store_silver(spark, lake.silver, silver_of(spark, sf_dir))
    restated = silver_of(spark, sf_dir).where(F.col("city_name") == "london").withColumn(
        "uv_index", F.col("uv_index") + 1
    )
    for _ in range(2):
        store_silver(spark, lake.silver, restated)
    return lake.silver.read(spark)


@query(f"""{DOCUMENTS + sql.silver()} SELECT {sql.SILVER_COLUMNS} FROM s WHERE city_name <> 'london'
  AND NOT (city_name = 'tokyo' AND d % 2 = 0)""".replace("d % 2", "EXTRACT(DAY FROM pipeline_run_date) % 2"))
def silver_replace_all_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One city restated without temperatures, another on even days without any hour:
    the old rows of these city-days go, all others stay."""
    lake = Lakehouse.at(new_folder(spark, "lake"))
    documents = documents_of(spark, sf_dir)
    run_silver(spark, lake, documents)
    nothing = F.transform("hourly.temperature_2m", lambda v: F.lit(None).cast("double"))
    bad = documents.where(F.col("city_name") == "london").withColumn(
        "hourly", F.col("hourly").withField("temperature_2m", nothing)
    )
    even = F.dayofmonth(F.col("pipeline_run_date").cast("date")) % 2 == 0
    no_hours = F.array().cast("array<string>")
    empty = documents.where((F.col("city_name") == "tokyo") & even).withColumn(
        "hourly", F.col("hourly").withField("time", no_hours)
    )
    run_silver(spark, lake, bad.unionByName(empty))
    return lake.silver.read(spark)


@query(f"""{SILVER} SELECT city_name, observation_date, COUNT(*) AS rejected,
  COUNT(CASE WHEN temperature_2m IS NULL THEN 1 END) AS no_temperature,
  COUNT(CASE WHEN relative_humidity_2m IS NULL THEN 1 END) AS no_humidity,
  COUNT(CASE WHEN wind_speed_10m IS NULL THEN 1 END) AS no_wind, CAST(0 AS BIGINT) AS no_time
FROM fs WHERE data_quality_flag = 'BAD' GROUP BY ALL""")
def silver_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_ops.rejects(hourly_readings(spark, sf_dir))


# --- Gold: daily summary ---------------------------------------------------------


@query(f"""{SILVER} SELECT city_name, observation_date, weather_condition, COUNT(*) AS condition_count
FROM s GROUP BY ALL""")
def gold_condition_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return condition_counts(silver_of(spark, sf_dir))


@query(f"{GOLD} SELECT * FROM g")
def gold_daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_of(spark, sf_dir)


@query(f"{LINES_GOLD} SELECT * FROM g")
def gold_daily_summary_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_of(spark, sf_dir, "lineitem")


@query(f"{GOLD} SELECT city_name, weather_date, total_precipitation, had_rain FROM g")
def gold_had_rain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_of(spark, sf_dir).select(
        "city_name", "weather_date", "total_precipitation", "had_rain"
    )


@query(f"{GOLD} SELECT city_name, weather_date, dominant_wind_direction FROM g")
def gold_dominant_wind(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_of(spark, sf_dir).select("city_name", "weather_date", "dominant_wind_direction")


@query(f"{GOLD} SELECT city_name, weather_date, dominant_condition, dominant_weather_code FROM g")
def gold_dominant_condition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_of(spark, sf_dir).select(
        "city_name", "weather_date", "dominant_condition", "dominant_weather_code"
    )


@query(f"{GOLD} SELECT city_name, weather_date, avg_temperature, avg_humidity, comfort_score FROM g")
def gold_comfort_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_of(spark, sf_dir).select(
        "city_name", "weather_date", "avg_temperature", "avg_humidity", "comfort_score"
    )


def two_daily_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Days up to the 20th; then days from the 10th on with other values and labels."""
    readings = hourly_readings(spark, sf_dir)
    day = F.col("pipeline_run_date")
    first = readings.where(day <= "2024-01-20")
    second = readings.where(day >= "2024-01-10").withColumns(
        {
            "city_display_name": F.upper("city_display_name"),
            "temperature_2m": F.col("temperature_2m") - 6,
            "uv_index": F.col("uv_index") + 1,
        }
    )
    return (
        to_daily(silver_ops.to_silver(first), dt.date(2024, 1, 21)),
        to_daily(silver_ops.to_silver(second), AS_OF),
    )


TWO_DAILY = (
    HOURLY
    + ", r1 AS (SELECT * FROM r WHERE d <= DATE '2024-01-20')"
    + sql.silver("s1", "r1")
    + sql.gold("g1", "s1", "2024-01-21")
    + ", r2a AS (SELECT * FROM r WHERE d >= DATE '2024-01-10')"
    + sql.changed("r2", "r2a", city_display_name="upper(city_display_name)",
                  temperature_2m="temperature_2m - 6", uv_index="uv_index + 1")
    + sql.silver("s2", "r2")
    + sql.gold("g2", "s2")
)


@query(f"{TWO_DAILY} {sql.merged_daily('g1', 'g2')}")
def gold_daily_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = Lakehouse.at(new_folder(spark, "lake"))
    for batch in two_daily_batches(spark, sf_dir):
        upsert_daily(spark, lake.daily, batch)
    return lake.daily.read(spark)


@query(f"""{SILVER} SELECT city_name, observation_date AS weather_date, COUNT(*) AS source_rows
FROM (SELECT DISTINCT city_name, observation_date,
  CASE WHEN observation_hour < 2 THEN upper(city_display_name) ELSE city_display_name END AS label FROM s) q
GROUP BY ALL HAVING COUNT(*) > 1""")
def merge_key_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A label that changes within a day gives two source rows for one key."""
    label = F.when(F.col("observation_hour") < 2, F.upper("city_display_name")).otherwise(
        F.col("city_display_name")
    )
    relabelled = silver_of(spark, sf_dir).withColumn("city_display_name", label)
    return upsert.duplicate_keys(to_daily(relabelled, AS_OF), DAILY_KEYS)


# --- Gold: extreme events --------------------------------------------------------


@query(f"{EVENTS} SELECT * FROM x")
def gold_extreme_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_of(spark, sf_dir)


@query(f"{LINES_EVENTS} SELECT * FROM x")
def gold_extreme_events_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_of(spark, sf_dir, "lineitem")


@query(f"{EVENTS} SELECT event_type, COUNT(*) AS events FROM x GROUP BY ALL")
def gold_event_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_of(spark, sf_dir).groupBy("event_type").agg(F.count("*").alias("events"))


@query(f"""{EVENTS} SELECT event_type, severity, COUNT(*) AS events FROM x GROUP BY ALL""")
def gold_event_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_of(spark, sf_dir).groupBy("event_type", "severity").agg(
        F.count("*").alias("events")
    )


MULTILABEL = " UNION ALL ".join(
    f"SELECT city_name, weather_date AS event_date, '{name}' AS event_type FROM g WHERE {test}"
    for name, test in sql.EVENT_TESTS.items()
)


@query(f"""{EVENTS}, m AS ({MULTILABEL})
SELECT m.city_name, m.event_date, m.event_type, x.severity
FROM m JOIN x ON m.city_name = x.city_name AND m.event_date = x.event_date""")
def gold_events_multilabel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_events_multilabel(daily_of(spark, sf_dir), AS_OF).select(
        "city_name", "event_date", "event_type", "severity"
    )


TWO_EVENTS = TWO_DAILY + sql.events("x1", "g1", "2024-01-21") + sql.events("x2", "g2")


def _upserted_events(spark: SparkSession, sf_dir: str, prune: bool) -> DataFrame:
    lake = Lakehouse.at(new_folder(spark, "lake"))
    first, second = two_daily_batches(spark, sf_dir)
    upsert_events(spark, lake.events, to_events(first, dt.date(2024, 1, 21)))
    reprocessed = (dt.date(2024, 1, 10), dt.date(2024, 1, 31)) if prune else None
    upsert_events(spark, lake.events, to_events(second, AS_OF), reprocessed)
    return lake.events.read(spark)


@query(f"{TWO_EVENTS} {sql.merged_events('x1', 'x2')}")
def gold_events_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days whose type changes keep their old event beside the new one."""
    return _upserted_events(spark, sf_dir, prune=False)


@query(f"""{TWO_EVENTS} {sql.merged_events('x1', 'x2',
    "t.event_date NOT BETWEEN DATE '2024-01-10' AND DATE '2024-01-31'")}""")
def gold_events_upsert_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upserted_events(spark, sf_dir, prune=True)


# --- Reports ---------------------------------------------------------------------

TREND_DAY, RAIN_DAY, RISK_DAY = dt.date(2024, 2, 15), dt.date(2024, 1, 25), dt.date(2024, 4, 15)
LINES_TREND_DAY, LINES_RAIN_DAY = dt.date(2001, 11, 10), dt.date(2001, 10, 25)
LINES_RISK_DAY = dt.date(2001, 12, 20)


def stored_daily(spark: SparkSession, sf_dir: str, table: str = "events") -> DataFrame:
    """Reports read a stored Gold table, as they do after a run."""
    return written(spark, daily_of(spark, sf_dir, table), "gold")


def stored_events(spark: SparkSession, sf_dir: str, table: str = "events") -> DataFrame:
    return written(spark, events_of(spark, sf_dir, table), "gold")


@query(f"{GOLD} {sql.temp_trend(str(TREND_DAY))}")
def temp_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.temp_trend(stored_daily(spark, sf_dir), TREND_DAY)


@query(f"{GOLD} {sql.temp_trend(str(TREND_DAY), calendar=True)}")
def temp_trend_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.temp_trend(stored_daily(spark, sf_dir), TREND_DAY, calendar=True)


@query(f"{GOLD} {sql.rainiest_cities(str(RAIN_DAY))}")
def rainiest_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.rainiest_cities(stored_daily(spark, sf_dir), RAIN_DAY)


@query(EVENTS + sql.extreme_summary(str(RISK_DAY)))
def extreme_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.extreme_summary(stored_events(spark, sf_dir), RISK_DAY)


@query(f"{EVENTS} {sql.extreme_timeline(str(TREND_DAY))}")
def extreme_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.extreme_timeline(stored_events(spark, sf_dir), TREND_DAY)


@query(f"{LINES_GOLD} {sql.temp_trend(str(LINES_TREND_DAY))}")
def temp_trend_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.temp_trend(stored_daily(spark, sf_dir, "lineitem"), LINES_TREND_DAY)


@query(f"{LINES_GOLD} {sql.rainiest_cities(str(LINES_RAIN_DAY))}")
def rainiest_cities_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.rainiest_cities(stored_daily(spark, sf_dir, "lineitem"), LINES_RAIN_DAY)


@query(LINES_EVENTS + sql.extreme_summary(str(LINES_RISK_DAY)))
def extreme_summary_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.extreme_summary(stored_events(spark, sf_dir, "lineitem"), LINES_RISK_DAY)


@query(f"{LINES_EVENTS} {sql.extreme_timeline(str(LINES_TREND_DAY))}")
def extreme_timeline_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.extreme_timeline(stored_events(spark, sf_dir, "lineitem"), LINES_TREND_DAY)


# --- Gates and runs --------------------------------------------------------------

DAYS = 32  # full days before AS_OF covered by the gates: one more than January
EXPECTED_DATES = """(SELECT CAST(range AS DATE) AS expected_date
  FROM range(DATE '2023-12-31', DATE '2024-02-01', INTERVAL 1 DAY))"""


@query(f"""{DOCUMENTS}, k AS (SELECT DISTINCT city_name, d, document FROM r)
SELECT c.city_name AS city, COUNT(k.document) AS documents,
  CASE WHEN COUNT(k.document) = 0 THEN 'FAIL' ELSE 'OK' END AS status
FROM {sql.CITIES} LEFT JOIN k ON k.city_name = c.city_name GROUP BY ALL""")
def gate_city_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.city_coverage(configured_cities(spark), documents_of(spark, sf_dir))


@query(f"""{DOCUMENTS}, k AS (SELECT DISTINCT city_name, d FROM r)
SELECT c.city_name AS city, expected_date,
  CASE WHEN COUNT(k.d) = 0 THEN 'FAIL' ELSE 'OK' END AS status
FROM {sql.CITIES} CROSS JOIN {EXPECTED_DATES} q
LEFT JOIN k ON k.city_name = c.city_name AND k.d = expected_date GROUP BY ALL""")
def gate_city_date_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The expected days reach beyond those landed on either side."""
    landing = landed(spark, documents_of(spark, sf_dir))
    start, end = gates.date_range(AS_OF, DAYS)
    files = landed_files(spark, landing)
    return gates.city_date_coverage(configured_cities(spark), files, start, end).select(
        "city", "expected_date", "status"
    )


@query(f"""{GOLD} SELECT COUNT(*) AS row_count, CAST({DAYS * len(CITIES)} AS BIGINT) AS expected_rows,
  CASE WHEN COUNT(*) = 0 THEN 'FAIL' WHEN COUNT(*) < {DAYS * len(CITIES)} * 0.9 THEN 'WARN' ELSE 'OK' END AS status FROM g""")
def gate_gold_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.gold_total_status(daily_of(spark, sf_dir), DAYS * len(CITIES))


@query(f"""{GOLD} SELECT expected_date, COUNT(g.city_name) AS row_count,
  CAST({len(CITIES)} AS BIGINT) AS expected_rows, CASE WHEN COUNT(g.city_name) = 0 THEN 'FAIL'
  WHEN COUNT(g.city_name) < {len(CITIES)} THEN 'WARN' ELSE 'OK' END AS status
FROM {EXPECTED_DATES} q LEFT JOIN g ON g.weather_date = expected_date GROUP BY ALL""")
def gate_gold_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = gates.date_grid(spark, *gates.date_range(AS_OF, DAYS))
    return gates.gold_daily_status(daily_of(spark, sf_dir), dates, len(CITIES))


@query(f"""SELECT expected_date, COUNT(event_id) AS readings FROM {EXPECTED_DATES} q
LEFT JOIN events ON CAST(ts AS DATE) = expected_date GROUP BY ALL""")
def date_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days of a backfill and the readings each one holds."""
    held = spark.read.parquet(f"{sf_dir}/events.parquet").groupBy(
        F.to_date("ts").alias("expected_date")
    ).agg(F.count("*").alias("held"))
    dates = gates.date_grid(spark, *gates.date_range(AS_OF, DAYS))
    return dates.join(held, "expected_date", "left").select(
        "expected_date", F.coalesce("held", F.lit(0)).alias("readings")
    )


DOCUMENT_GOLD = DOCUMENTS + sql.silver() + sql.gold()


@query(f"""{DOCUMENT_GOLD} SELECT * REPLACE (
  CASE WHEN weather_date >= DATE '2024-01-29' THEN CAST(weather_date + INTERVAL 1 DAY AS DATE)
    ELSE DATE '2024-01-29' END AS first_seen_date,
  CASE WHEN weather_date >= DATE '2024-01-29' THEN CAST(weather_date + INTERVAL 1 DAY AS DATE)
    ELSE DATE '2024-01-29' END AS last_updated_date) FROM g""")
def backfill_equals_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A backfill of the first four weeks, then a run on each following day."""
    lake = Lakehouse.at(new_folder(spark, "lake"))
    bronze = landed(spark, documents_of(spark, sf_dir))
    cities = configured_cities(spark)
    run_backfill(spark, bronze, lake, cities, dt.date(2024, 1, 29), 28, require_coverage=False)
    for today in (dt.date(2024, 1, 30), dt.date(2024, 1, 31)):
        run_daily(spark, bronze, lake, cities, today, require_coverage=False)
    return lake.daily.read(spark)


@query(f"""{DOCUMENT_GOLD} SELECT * REPLACE (DATE '2024-01-31' AS first_seen_date) FROM g""")
def rerun_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same range twice: only the date of the last update differs."""
    lake = Lakehouse.at(new_folder(spark, "lake"))
    bronze = landed(spark, documents_of(spark, sf_dir))
    start, end = dt.date(2024, 1, 1), dt.date(2024, 1, 30)
    for as_of in (dt.date(2024, 1, 31), AS_OF):
        run_range(
            spark, bronze, lake, configured_cities(spark), start, end, as_of,
            require_coverage=False,
        )
    return lake.daily.read(spark)


@query(DOCUMENT_GOLD + sql.events("x", "g") + " SELECT * FROM x")
def run_range_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze to extreme events in one run."""
    lake = Lakehouse.at(new_folder(spark, "lake"))
    bronze = landed(spark, documents_of(spark, sf_dir))
    run_range(
        spark, bronze, lake, configured_cities(spark), dt.date(2024, 1, 1),
        dt.date(2024, 1, 30), AS_OF, require_coverage=False,
    )
    return lake.events.read(spark)


@query(f"""{SILVER} SELECT city_name, observation_timestamp, timezone, ingestion_timestamp, observed_utc
FROM (SELECT *, observation_timestamp - to_minutes(utc_minutes) AS observed_utc FROM s) q
WHERE observed_utc > ingestion_timestamp""")
def dq_provisional_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.provisional_hours(silver_of(spark, sf_dir)).select(
        "city_name", "observation_timestamp", "timezone", "ingestion_timestamp", "observed_utc"
    )


@query(f"{DOCUMENT_GOLD} SELECT * FROM g")
def stream_daily_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landing read as a stream, in several batches."""
    lake = Lakehouse.at(new_folder(spark, "lake"))
    landing = landed(spark, documents_of(spark, sf_dir))
    stream = stream_daily(
        spark, landing, lake, new_folder(spark, "stream"), AS_OF,
        files_per_batch=100,
    )
    stream.awaitTermination()
    return lake.daily.read(spark)


QUARANTINE = f"""{DOCUMENTS} SELECT d AS landed_date, city_name AS city, COUNT(*) AS malformed
FROM (SELECT DISTINCT d, city_name, document FROM r) q WHERE document % 7 = 3 GROUP BY ALL"""


def _malformed_counts(malformed: DataFrame) -> DataFrame:
    return malformed.groupBy("landed_date", "city").agg(F.count("*").alias("malformed"))


@query(QUARANTINE)
def run_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run over a landing with broken documents stores them; no date is without a good one."""
    lake = Lakehouse.at(new_folder(spark, "lake"))
    run_range(
        spark, landed_broken(spark, sf_dir, whole=True), lake, configured_cities(spark), dt.date(2024, 1, 1),
        dt.date(2024, 1, 30), AS_OF, require_coverage=False,
    )
    return _malformed_counts(lake.malformed.read(spark))


@query(QUARANTINE)
def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream stores the broken documents of each batch."""
    lake = Lakehouse.at(new_folder(spark, "lake"))
    quarantine_of_stream(
        spark, landed_broken(spark, sf_dir), lake, new_folder(spark, "stream"), files_per_batch=100
    ).awaitTermination()
    stored = spark.read.schema(lake.malformed.schema).parquet(f"{lake.malformed.root}/stream/*")
    return _malformed_counts(stored)


@query(f"{DOCUMENT_GOLD} SELECT * FROM g")
def stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest week lands and is drained first; what comes weeks late is in Gold too."""
    lake = Lakehouse.at(new_folder(spark, "lake"))
    documents, checkpoint = documents_of(spark, sf_dir), new_folder(spark, "stream")
    late = F.col("day") < "24"
    landing = landed(spark, documents.where(~late))
    stream_daily(spark, landing, lake, checkpoint, AS_OF).awaitTermination()
    write_bronze(documents.where(late), landing)
    stream_daily(spark, landing, lake, checkpoint, AS_OF).awaitTermination()
    return lake.daily.read(spark)


# --- Runs with the strict gate -----------------------------------------------------

JANUARY = (dt.date(2024, 1, 1), dt.date(2024, 1, 30))


def whole_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of all city-days of the range: without an event, one hour without values."""
    documents = documents_of(spark, sf_dir)
    grid = configured_cities(spark).select(
        F.col("name").alias("city_name"), F.col("display_name").alias("city_display_name"), "country",
        "latitude", "longitude", "timezone", F.lit("2024-02-01T06:00:00").alias("ingestion_timestamp"),
        F.explode(F.sequence(F.lit(JANUARY[0]), F.lit(JANUARY[1])).cast("array<string>")).alias("pipeline_run_date"),
    )
    nothing = F.array(F.lit(None).cast("double"))
    hourly = F.struct(
        F.array(F.concat("pipeline_run_date", F.lit("T00:00"))).alias("time"),
        *[nothing.alias(v) for v in HOURLY_VARIABLES],
    )
    kinds = {f.name: f.dataType for f in documents.schema.fields}
    silent = grid.join(documents, ["city_name", "pipeline_run_date"], "left_anti").withColumn("hourly", hourly)
    silent = shape.with_partition_keys(as_documents(silent))
    return documents.drop("document").unionByName(
        silent.select(*[F.col(c).cast(kinds[c]).alias(c) for c in documents.columns if c != "document"])
    )


@query(f"{DOCUMENT_GOLD} SELECT * FROM g")
def run_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that wants a document of every city and date, over a landing that has them."""
    lake = Lakehouse.at(new_folder(spark, "lake"))
    bronze = landed(spark, whole_landing(spark, sf_dir))
    run_range(spark, bronze, lake, configured_cities(spark), *JANUARY, AS_OF)
    return lake.daily.read(spark)


@query(f"""{DOCUMENTS}, k AS (SELECT DISTINCT city_name, d FROM r WHERE NOT (city_name = 'london' AND d = DATE '2024-01-15'))
SELECT c.city_name AS city, expected_date, CAST(0 AS BIGINT) AS documents, 'FAIL' AS status,
  CAST(0 AS BIGINT) AS gold_rows
FROM {sql.CITIES} CROSS JOIN (SELECT CAST(range AS DATE) AS expected_date
  FROM range(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY)) q
WHERE c.city_name = 'london' AND expected_date = DATE '2024-01-15'
  AND NOT EXISTS (SELECT 1 FROM k WHERE k.city_name = c.city_name AND k.d = expected_date)""")
def run_strict_fail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One city-day has not landed: the run stops before Silver and says which."""
    lake, cities = Lakehouse.at(new_folder(spark, "lake")), configured_cities(spark)
    missing = (F.col("city") == "london") & (F.col("pipeline_run_date") == "2024-01-15")
    bronze = landed(spark, whole_landing(spark, sf_dir).where(~missing))
    try:
        run_range(spark, bronze, lake, cities, *JANUARY, AS_OF)
        raise AssertionError("the gate let a missing city-day pass")
    except gates.GateFailed:
        pass
    found = gates.city_date_coverage(cities, good_documents(read_bronze(spark, bronze, *JANUARY)), *JANUARY)
    stored = lake.silver.read(spark).count() + lake.daily.read(spark).count()
    return found.where(F.col("status") == "FAIL").withColumn("gold_rows", F.lit(stored).cast("bigint"))


# --- SQL tables ----------------------------------------------------------------------


@query(f"{TWO_DAILY} {sql.merged_daily('g1', 'g2')}")
def sql_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog tables are made before anything is stored, and follow two upserts."""
    database = f"nimbra_{uuid.uuid4().hex}"
    lake = Lakehouse.at(new_folder(spark, "lake"), database=database)
    lake.create_tables(spark)
    for batch in two_daily_batches(spark, sf_dir):
        upsert_daily(spark, lake.daily, batch)
    return spark.sql(f"SELECT * FROM {database}.gold_daily_summary").drop("slice")


@query(f"""{DOCUMENTS} SELECT city, year, month, day, COUNT(*) AS documents
FROM (SELECT DISTINCT {PARTITION_SQL}, document FROM r) q WHERE document % 7 <> 3 GROUP BY ALL""")
def sql_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The SQL view of a landing holds its documents alone."""
    database = f"nimbra_{uuid.uuid4().hex}"
    register_bronze(spark, database, "bronze", landed_broken(spark, sf_dir))
    return spark.sql(
        f"SELECT city, year, month, day, COUNT(*) AS documents FROM {database}.bronze_documents GROUP BY ALL"
    )


# --- Gold from stored parts ------------------------------------------------------------

RESTATED = (
    DOCUMENTS
    + sql.changed("r2", "r", uv_index="CASE WHEN document % 5 = 0 THEN uv_index + 1 ELSE uv_index END")
    + sql.silver("s2", "r2")
    + sql.gold("g2", "s2")
)


@query(f"{RESTATED} SELECT * FROM g2")
def gold_from_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth document is restated: its partial summaries are replaced, and Gold is merged
    from the stored ones; no other reading is read again."""
    lake, documents = Lakehouse.at(new_folder(spark, "lake")), documents_of(spark, sf_dir)

    def store(of: DataFrame) -> None:
        named = of.withColumn("document", F.col("document").cast("string"))
        readings = silver_ops.flagged(silver_ops.explode_hours(named, "document"), "document")
        store_partials(spark, lake.partials, partial_summaries(readings, "document"), named)

    store(documents)
    raised = F.transform("hourly.uv_index", lambda v: v + 1)
    store(documents.where(F.col("document") % 5 == 0).withColumn("hourly", F.col("hourly").withField("uv_index", raised)))
    return summary_of_partials(lake.partials.read(spark), AS_OF)


@query(f"""{SILVER}, w AS (SELECT city_name, CAST(date_trunc('week', observation_date) AS DATE) AS week,
  wind_direction_10m, COUNT(*) AS n FROM s WHERE wind_direction_10m IS NOT NULL GROUP BY ALL)
SELECT city_name, week, wind_direction_10m AS dominant_wind_direction, n AS hours FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY city_name, week ORDER BY n DESC, wind_direction_10m) AS place FROM w) q
WHERE place = 1""")
def gold_wind_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly dominant wind from stored sketches of the city-days."""
    daily = written(spark, wind_sketches(silver_of(spark, sf_dir)), "sketches")
    return dominant_wind(daily, "city_name", F.trunc("weather_date", "week").alias("week"))
