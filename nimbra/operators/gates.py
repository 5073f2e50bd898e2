"""Quality gates and completeness checks; every gate is a DataFrame of findings."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbra.fixed_values import GOLD_COMPLETENESS, HOURS_PER_DAY


class GateFailed(ValueError):
    pass


def require_empty(findings: DataFrame, what: str) -> None:
    found = findings.take(5)
    if found:
        total = findings.count()
        raise GateFailed(f"{what}: {total}, such as {[r.asDict() for r in found]}")


def require_no_failure(statuses: DataFrame, what: str) -> None:
    require_empty(statuses.where(F.col("status") == "FAIL"), what)


def date_range(end_before: dt.date, days: int) -> tuple[dt.date, dt.date]:
    """First and last date of the ``days`` full days before ``end_before``."""
    last = end_before - dt.timedelta(days=1)
    return last - dt.timedelta(days=days - 1), last


def date_grid(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per date, ``start`` to ``end`` inclusive."""
    return spark.range(1, numPartitions=1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end))).alias("expected_date")
    )


def city_coverage(cities: DataFrame, documents: DataFrame) -> DataFrame:
    """Documents (or their files) per expected city: FAIL where there is none."""
    loaded = documents.groupBy("city").agg(F.count("*").alias("loaded"))
    return _coverage(cities.select(F.col("name").alias("city")), loaded, ["city"])


def city_date_coverage(
    cities: DataFrame, documents: DataFrame, start: dt.date, end: dt.date
) -> DataFrame:
    """Documents per expected (city, date) key: FAIL where there is none.

    The grid is made by giving each city its dates; it has one row per city
    and day whatever the number of documents.
    """
    grid = cities.select(
        F.col("name").alias("city"),
        F.explode(F.sequence(F.lit(start), F.lit(end))).alias("expected_date"),
    )
    day = F.concat_ws("-", "year", "month", "day").cast("date")
    loaded = documents.groupBy("city", day.alias("expected_date")).agg(F.count("*").alias("loaded"))
    return _coverage(grid, loaded, ["city", "expected_date"])


def _coverage(expected: DataFrame, loaded: DataFrame, keys: list[str]) -> DataFrame:
    documents = F.coalesce("loaded", F.lit(0))
    return expected.join(loaded, keys, "left").select(
        *keys,
        documents.alias("documents"),
        F.when(documents == 0, "FAIL").otherwise("OK").alias("status"),
    )


def gold_total_status(daily: DataFrame, expected_rows: int) -> DataFrame:
    """Whole-table row count: FAIL when empty, WARN below 90% of the expected rows."""
    return daily.agg(F.count("*").alias("row_count")).select(
        "row_count",
        F.lit(expected_rows).cast("bigint").alias("expected_rows"),
        F.when(F.col("row_count") == 0, "FAIL")
        .when(F.col("row_count") < expected_rows * GOLD_COMPLETENESS, "WARN")
        .otherwise("OK")
        .alias("status"),
    )


def gold_daily_status(daily: DataFrame, dates: DataFrame, expected_cities: int) -> DataFrame:
    """Row count per run date: FAIL when there is none, WARN below the city count."""
    counts = daily.groupBy(F.col("weather_date").alias("expected_date")).agg(
        F.count("*").alias("loaded")
    )
    count = F.coalesce("loaded", F.lit(0))
    return dates.join(counts, "expected_date", "left").select(
        "expected_date",
        count.alias("row_count"),
        F.lit(expected_cities).cast("bigint").alias("expected_rows"),
        F.when(count == 0, "FAIL").when(count < expected_cities, "WARN").otherwise("OK").alias(
            "status"
        ),
    )


def incomplete_days(daily: DataFrame) -> DataFrame:
    """City-days with fewer than 24 readings in the summary."""
    return daily.where(F.col("record_count") < HOURS_PER_DAY).select(
        "city_name", "weather_date", "record_count"
    )


def provisional_hours(silver: DataFrame) -> DataFrame:
    """Readings of hours that were still to come when they were ingested."""
    observed = F.convert_timezone(
        F.col("timezone"), F.lit("UTC"), F.col("observation_timestamp")
    )
    return silver.withColumn("observed_utc", observed).where(
        F.col("observed_utc") > F.col("ingestion_timestamp")
    )
