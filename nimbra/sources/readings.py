"""Binding of the provided tables to hourly readings.

The engine's inputs are hourly series per city; the provided tables hold event
and order-line rows. Here a row becomes one reading: the city comes from a key
modulo the number of cities, the hour from the row itself, the measures from integer arithmetic divided by ten (the same double in every
engine).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nimbra.fixed_values import CITIES, HOURS_PER_DAY
from nimbra.sources.cities import configured_cities

# A document holds the readings of one city-day and one run of event ids. Event
# ids are unique, so no document can exceed this many readings.
DOCUMENT_SPAN = 256

# Codes by position, used by the measure arithmetic below.
_CODES = [0, 1, 2, 3, 45, 51, 61, 63, 71, 77, 80, 85, 95, 96, 100]

_EVENTS_ORDER = ["ts", "event_id"]


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id",
        "event_type",
        (F.col("user_id") % len(CITIES)).cast("int").alias("ci"),
        F.to_date("ts").alias("d"),
        F.hour("ts").alias("hour"),
        "ts",
    )


def _lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        (F.col("l_orderkey") * 7 + F.col("l_partkey") + F.col("l_linenumber")).alias("event_id"),
        F.when(F.col("l_returnflag") == "R", "error").otherwise("view").alias("event_type"),
        (F.col("l_suppkey") % len(CITIES)).cast("int").alias("ci"),
        F.to_date("l_shipdate").alias("d"),
        ((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % HOURS_PER_DAY).cast("int").alias("hour"),
    )


def _measures() -> list[Column]:
    i, ci, dom = F.col("event_id"), F.col("ci"), F.dayofmonth("d")
    base = (ci * 131 + dom * 17) % 60 - 8

    def tenths(x: Column) -> Column:
        return x.cast("double") / 10

    rain_day = (F.col("event_type") == "error") & ((ci + dom) % 3 == 0)
    amount = tenths((i % 90) * ((ci + dom * 2) % 7))
    gust = F.when((ci * 5 + dom) % 9 == 0, (dom * 130) % 1100).otherwise(0)
    code_at = (ci * 3 + dom * 5) % 14 + F.when(i % 4 == 0, 1).otherwise(0)
    codes = F.array(*[F.lit(c) for c in _CODES])
    return [
        F.when(i % 97 == 0, F.lit(None).cast("double"))
        .when(i % 397 == 1, F.lit(75.0))
        .otherwise(tenths(base * 10 + i % 50))
        .alias("temperature_2m"),
        F.when(i % 199 == 0, F.lit(None).cast("int"))
        .when(i % 211 == 1, 105)
        .otherwise((20 + (i * 7) % 79).cast("int"))
        .alias("relative_humidity_2m"),
        tenths(base * 10 + i % 70 - 15).alias("apparent_temperature"),
        F.when(rain_day, amount).otherwise(0.0).alias("precipitation"),
        F.when(rain_day & (base >= 0), amount).otherwise(0.0).alias("rain"),
        tenths(50 + i % 200 + gust).alias("wind_speed_10m"),
        (((i * 53) % 16) * 22).cast("int").alias("wind_direction_10m"),
        F.get(codes, code_at.cast("int")).alias("weather_code"),
        tenths((i % 5 + (ci * 7 + dom * 3) % 7) * 10).alias("uv_index"),
    ]


def _with_city(spark: SparkSession, rows: DataFrame) -> DataFrame:
    names = F.array(*[F.lit(c["name"]) for c in CITIES])
    cities = configured_cities(spark).select(
        F.array_position(names, F.col("name")).cast("int").alias("at"),
        F.col("name").alias("city_name"),
        F.col("display_name").alias("city_display_name"),
        "country", "latitude", "longitude", "timezone",
    )
    return rows.join(cities, F.col("ci") + 1 == F.col("at")).withColumn(
        "pipeline_run_date", F.col("d").cast("string")
    )


def _as_readings(rows: DataFrame, *carried: str) -> DataFrame:
    hour = F.lpad(F.col("hour").cast("string"), 2, "0")
    return rows.select(
        "city_name", "city_display_name", "country", "latitude", "longitude", "timezone",
        F.concat(F.date_add("d", 1).cast("string"), F.lit("T00:05:00")).alias("ingestion_timestamp"),
        "pipeline_run_date",
        F.concat("pipeline_run_date", F.lit("T"), hour, F.lit(":00")).alias("raw_timestamp"),
        *_measures(),
        *carried,
    )


def hourly_readings(spark: SparkSession, sf_dir: str, table: str = "events") -> DataFrame:
    """Every row as a reading of its city, date and hour; no shuffle, no row left out.

    Several rows may share an hour, as with several sensors of a city.
    """
    bind = {"events": _events, "lineitem": _lineitem}[table]
    return _as_readings(_with_city(spark, bind(spark, sf_dir)))


def document_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a reading of a document, with ``document`` and ``hour_index``.

    The rows of a city-day are spread over documents of bounded size, so
    neither the numbering nor the collecting ever holds a whole city-day. Both
    use the same keys, hence one shuffle.
    """
    rows = _with_city(spark, _events(spark, sf_dir)).withColumn(
        "document", F.floor(F.col("event_id") / DOCUMENT_SPAN)
    )
    within = Window.partitionBy("document", "city_name", "pipeline_run_date").orderBy(*_EVENTS_ORDER)
    numbered = rows.withColumn("hour_index", F.row_number().over(within)).withColumn(
        "hour", (F.col("hour_index") - 1) % HOURS_PER_DAY
    )
    return _as_readings(numbered, "document", "hour_index")
