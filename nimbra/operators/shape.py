"""Shaping of landed responses into Bronze documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nimbra.fixed_values import HOURLY_VARIABLES, HOURS_PER_DAY
from nimbra.sources.bronze import partition_text

SERIES = ["time", *HOURLY_VARIABLES]


def require_hourly(responses: DataFrame) -> DataFrame:
    """Fail the job on a response without its hourly block."""
    city = F.coalesce(*[c for c in ("city", "city_name") if c in responses.columns], F.lit("?"))
    present = F.assert_true(
        F.col("hourly").isNotNull(), F.concat(F.lit("no hourly data returned for "), city)
    )
    return responses.where(present.isNull())


def missing_hourly(responses: DataFrame) -> DataFrame:
    return responses.where(F.col("hourly").isNull())


def attach_metadata(responses: DataFrame, cities: DataFrame, ingested_at: Column) -> DataFrame:
    """City names and country by ``city``, and the ingestion time."""
    dimension = cities.select(
        F.col("name").alias("city"),
        F.col("name").alias("city_name"),
        F.col("display_name").alias("city_display_name"),
        "country",
    )
    dropped = [c for c in ("city_name", "city_display_name", "country") if c in responses.columns]
    return (
        responses.drop(*dropped)
        .join(dimension, "city")
        .withColumn("ingestion_timestamp", ingested_at)
    )


def _local_date(i: Column) -> Column:
    return F.substring(F.get("hourly.time", i), 1, 10)


def _positions(date: Column) -> Column:
    """Positions of one local date, in series order."""
    n = F.size("hourly.time")
    every = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.filter(every, lambda i: _local_date(i) == date)


def _with_series_at(responses: DataFrame, positions: str) -> DataFrame:
    """Every series cut to the given positions; a missing series stays missing."""
    def cut(variable: str) -> Column:
        series = F.col(f"hourly.{variable}")
        values = F.transform(positions, lambda i: F.get(series, i))
        return F.when(series.isNotNull(), values).alias(variable)

    return responses.withColumn("hourly", F.struct(*[cut(v) for v in SERIES])).drop(positions)


def _dates() -> Column:
    return F.transform("hourly.time", lambda t: F.substring(t, 1, 10))


def in_date_order(responses: DataFrame) -> DataFrame:
    """Hours in the order of their dates, and of their positions within a date; a response
    that is in order already, as they all should be, is only looked at."""
    def entry(date: Column, i: Column) -> Column:
        return F.struct(date.alias("date"), i.alias("i"))

    order = F.transform(F.array_sort(F.transform("dates", entry)), lambda x: x["i"])

    def put(variable: str) -> Column:
        series = F.col(f"hourly.{variable}")
        moved = F.transform(order, lambda i: F.get(series, i))
        return F.when(series.isNotNull(), moved).alias(variable)

    dated = responses.withColumn("dates", _dates())
    in_order = F.col("dates") == F.sort_array("dates")
    moved = F.when(in_order, F.struct(*[F.col(f"hourly.{v}").alias(v) for v in SERIES])).otherwise(
        F.struct(*[put(v) for v in SERIES])
    )
    return dated.withColumn("hourly", moved).withColumn("dates", F.sort_array("dates"))


def split_daily(responses: DataFrame) -> DataFrame:
    """One document per local date of each response, with its partition keys.

    Works inside the row, in time that grows with the hours: each date is a run of the
    ordered hours, and every series is cut by start and length of the runs. A response is
    cut where it is read, with no shuffle. Hours without a time form a document of their
    own, without a date.
    """
    n = F.size("dates")
    every = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    begins = F.filter(every, lambda i: ~F.get("dates", i).eqNullSafe(F.get("dates", i - 1)) | (i == 0))
    runs = in_date_order(responses).withColumn("begins", begins)

    def cut(begin: Column, k: Column) -> Column:
        length = F.coalesce(F.get("begins", k + 1), n) - begin

        def of(variable: str) -> Column:
            series = F.col(f"hourly.{variable}")
            return F.when(series.isNotNull(), F.slice(series, begin + 1, length)).alias(variable)

        date = F.get("dates", begin).alias("pipeline_run_date")
        return F.struct(date, F.struct(*[of(v) for v in SERIES]).alias("hourly"))

    # the cuts are exploded, not the runs: a row takes its own hours along, not all of them
    kept = [c for c in responses.columns if c not in ("hourly", "pipeline_run_date")]
    split = runs.select(*kept, F.explode(F.transform("begins", cut)).alias("cut"))
    return with_partition_keys(split.select(*kept, "cut.pipeline_run_date", "cut.hourly"))


def keep_date(responses: DataFrame, run_date: Column) -> DataFrame:
    """Each response cut to one local date, which may leave it empty."""
    dated = responses.withColumn("pipeline_run_date", run_date).withColumn(
        "positions", _positions(F.col("pipeline_run_date"))
    )
    return with_partition_keys(_with_series_at(dated, "positions"))


def with_partition_keys(documents: DataFrame) -> DataFrame:
    keys = partition_text(F.col("pipeline_run_date").cast("date"))
    return documents.withColumns({"city": F.col("city_name"), **keys})


def hour_count_off(documents: DataFrame) -> DataFrame:
    """Documents that do not hold exactly one day of hours: a warning, not a failure."""
    hours = F.coalesce(F.size("hourly.time"), F.lit(0))
    return documents.withColumn("hours", F.greatest(hours, F.lit(0))).where(
        F.col("hours") != HOURS_PER_DAY
    )


def collect_documents(readings: DataFrame, keys: list[str], position: str) -> DataFrame:
    """Parallel arrays in position order, one document per ``keys``.

    ``keys`` must identify a document, which has a bounded number of readings;
    a whole city-day of several documents is never gathered.
    """
    row = F.struct(position, F.col("raw_timestamp").alias("time"), *HOURLY_VARIABLES)
    gathered = readings.groupBy(*keys).agg(F.sort_array(F.collect_list(row)).alias("rows"))
    series = F.struct(*[F.col(f"rows.{v}").alias(v) for v in SERIES])
    return gathered.withColumn("hourly", series).drop("rows")
