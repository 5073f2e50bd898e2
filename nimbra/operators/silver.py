"""Bronze documents to Silver: one typed, decoded, flagged row per city-hour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nimbra.fixed_values import HOURLY_VARIABLES
from nimbra.functions.weather import condition_label, quality_flag
from nimbra.schemas import SILVER

METADATA = [
    "city_name", "city_display_name", "country", "latitude", "longitude", "timezone",
    "ingestion_timestamp", "pipeline_run_date",
]


def explode_hours(documents: DataFrame, *carried: str) -> DataFrame:
    """One row per position of the hourly arrays, all of them: a local day may have 23 or 25 hours.

    ``get`` is null past the end of a short array and for a missing variable,
    so a reading is kept whatever its document lacks. Positions that do not
    exist are not emitted: their temperature would be null, hence BAD.
    """
    return documents.select(
        *METADATA, *carried, "hourly", F.posexplode("hourly.time").alias("position", "raw_timestamp")
    ).select(
        *METADATA,
        *carried,
        "position",
        "raw_timestamp",
        *[F.get(f"hourly.{v}", F.col("position")).alias(v) for v in HOURLY_VARIABLES],
    )


def _timestamp(text: str, tolerant: bool) -> Column:
    column = F.col(text)
    return column.try_cast("timestamp_ntz") if tolerant else column.cast("timestamp_ntz")


def time_parts(readings: DataFrame, tolerant: bool = False) -> DataFrame:
    """Local ISO text to timestamp, date and hour.

    Unparseable text fails the job, or gives nulls when ``tolerant``.
    """
    return readings.withColumn(
        "observation_timestamp", _timestamp("raw_timestamp", tolerant)
    ).withColumns(
        {
            "observation_date": F.col("observation_timestamp").cast("date"),
            "observation_hour": F.hour("observation_timestamp"),
        }
    )


def flagged(readings: DataFrame, *carried: str, tolerant: bool = False) -> DataFrame:
    """All 22 Silver columns of every reading, BAD ones included."""
    enriched = time_parts(readings, tolerant).withColumns(
        {
            "weather_condition": condition_label(F.col("weather_code")),
            "ingestion_timestamp": _timestamp("ingestion_timestamp", tolerant),
            "pipeline_run_date": F.col("pipeline_run_date").cast("date"),
            "data_quality_flag": quality_flag(
                F.col("temperature_2m"), F.col("relative_humidity_2m"), F.col("wind_speed_10m")
            ),
        }
    )
    return enriched.select(*SILVER.fieldNames(), *carried)


def to_silver(readings: DataFrame, tolerant: bool = False) -> DataFrame:
    """GOOD and SUSPECT readings that have a date (all have one unless ``tolerant``)."""
    kept = (F.col("data_quality_flag") != "BAD") & F.col("observation_date").isNotNull()
    return flagged(readings, tolerant=tolerant).where(kept)


def rejects(readings: DataFrame, tolerant: bool = False, carried: tuple[str, ...] = ()) -> DataFrame:
    """Readings that Silver leaves out, counted per city-day (and ``carried``) with their reasons.

    Silver and these counts add up to the readings. The date of readings without a
    readable time is null.
    """
    return (
        flagged(readings, *carried, tolerant=tolerant)
        .where((F.col("data_quality_flag") == "BAD") | F.col("observation_date").isNull())
        .groupBy(*carried, "city_name", "observation_date")
        .agg(
            F.count("*").alias("rejected"),
            F.count_if(F.col("temperature_2m").isNull()).alias("no_temperature"),
            F.count_if(F.col("relative_humidity_2m").isNull()).alias("no_humidity"),
            F.count_if(F.col("wind_speed_10m").isNull()).alias("no_wind"),
            F.count_if(F.col("observation_date").isNull()).alias("no_time"),
        )
    )


CITY_DAY = ["city_name", "observation_date"]


def document_city_days(documents: DataFrame) -> DataFrame:
    """City-days that ``documents`` state, whether a reading of them survives or not:
    the date of the run and the dates of their hours."""
    hours = F.transform(
        F.coalesce("hourly.time", F.array().cast("array<string>")),
        lambda text: F.substring(text, 1, 10).try_cast("date"),
    )
    dates = F.array_distinct(F.array_append(hours, F.col("pipeline_run_date").try_cast("date")))
    stated = documents.select("city_name", F.explode(dates).alias("observation_date"))
    return stated.where(F.col("observation_date").isNotNull()).distinct()


def kept_rows(existing: DataFrame, restated: DataFrame) -> DataFrame:
    """Existing rows of the city-days that are not in ``restated``.

    Silver is replaced per (city, date): other cities of a date keep their rows.
    """
    return existing.join(restated, CITY_DAY, "left_anti").select(existing.columns)
