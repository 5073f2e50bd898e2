"""Runs over a range of dates: a daily run is a range of one day."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from nimbra.fixed_values import BACKFILL_DAYS, HOURS_PER_DAY
from nimbra.operators import daily as daily_ops
from nimbra.operators import gates, shape
from nimbra.operators.daily import to_daily
from nimbra.operators.events import to_events
from nimbra.operators.silver import (
    CITY_DAY,
    document_city_days,
    explode_hours,
    kept_rows,
    rejects,
    to_silver,
)
from nimbra.operators.upsert import merge_daily, merge_events, require_unique
from nimbra.schemas import BRONZE, CORRUPT_COLUMN
from nimbra.scratch import new_folder
from nimbra.sources.bronze import read_bronze, write_bronze
from nimbra.sources.tables import (
    SlicedTable,
    gold_daily_table,
    gold_events_table,
    malformed_table,
    partials_table,
    rejects_table,
    silver_table,
)


@dataclass(frozen=True)
class Lakehouse:
    """The Silver, Gold and quarantine tables under one root."""

    silver: SlicedTable
    daily: SlicedTable
    events: SlicedTable
    malformed: SlicedTable
    rejects: SlicedTable
    partials: SlicedTable

    @staticmethod
    def at(root: str, gold_slices: str = "yyyy-MM", database: str | None = None) -> Lakehouse:
        """``gold_slices``: the part of a date that names a slice of the Gold tables;
        ``database``: where ``create_tables`` makes them catalog tables."""
        tables = (
            silver_table(root),
            gold_daily_table(root, gold_slices),
            gold_events_table(root, gold_slices),
            malformed_table(root),
            rejects_table(root),
            partials_table(root),
        )
        if database:
            tables = [replace(t, catalog_name=f"{database}.{t.root.rpartition('/')[2]}") for t in tables]
        return Lakehouse(*tables)

    def create_tables(self, spark: SparkSession) -> None:
        """Create database and tables for SQL users if absent. From then on every commit points
        their partitions to the new version, so a query sees the current rows."""
        for table in (self.silver, self.daily, self.events, self.malformed, self.rejects):
            table.create_table(spark)

    def create_views(self, spark: SparkSession) -> None:
        """Current tables as temporary views for SQL users."""
        self.silver.read(spark).createOrReplaceTempView("silver_hourly")
        self.daily.read(spark).createOrReplaceTempView("gold_daily_summary")
        self.events.read(spark).createOrReplaceTempView("gold_extreme_events")


def land_history(
    responses: DataFrame, cities: DataFrame, bronze_root: str, ingested_at: Column
) -> None:
    """Land multi-day responses, with their ``city``, as one document per date."""
    whole = shape.attach_metadata(shape.require_hourly(responses), cities, ingested_at)
    write_bronze(shape.split_daily(whole), bronze_root)


def land_day(
    responses: DataFrame, cities: DataFrame, bronze_root: str, run_date: dt.date,
    ingested_at: Column,
) -> DataFrame:
    """Land the hours of one local date; returns documents without a full day of them."""
    whole = shape.attach_metadata(shape.require_hourly(responses), cities, ingested_at)
    day = shape.keep_date(whole, F.lit(str(run_date)))
    write_bronze(day, bronze_root)
    return shape.hour_count_off(day)


def written(spark: SparkSession, rows: DataFrame, label: str) -> DataFrame:
    """``rows`` from a table in the shared folder, computed once."""
    folder = new_folder(spark, label)
    rows.write.parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def store_silver(
    spark: SparkSession,
    table: SlicedTable,
    incoming: DataFrame,
    restated: DataFrame | None = None,
) -> None:
    """Replace city-days in Silver: the incoming ones and those of ``restated``.

    ``restated`` names the city-days that the documents state; one whose readings are
    all rejected has no incoming row, and loses its old ones. Incoming rows are computed and written once, into the new version; rows of
    other cities on the same dates are carried over into it before it
    becomes current. A run that restates every city, found out from the two key
    columns, reads nothing else of the old rows.
    """
    version = table.stage(spark, incoming)
    city_days = version.read(spark).select(CITY_DAY)
    dates = set(version.slices(spark))
    if restated is not None:
        restated = written(spark, restated.select(CITY_DAY), "restated")
        city_days = city_days.unionByName(restated)
        dates |= set(table.slices_in(restated))
    city_days, dates = city_days.distinct(), sorted(dates)
    existing = table.read_slices(spark, dates)
    if existing is not None:
        old = existing.select(CITY_DAY).distinct()
        if not old.join(city_days, CITY_DAY, "left_anti").isEmpty():
            version.add(kept_rows(existing, city_days))
    version.commit(spark, dates)


def upsert_daily(spark: SparkSession, table: SlicedTable, source: DataFrame) -> None:
    source = written(spark, source, "daily")
    require_unique(source, daily_ops.KEYS)
    months = table.slices_in(source)
    target = table.read_slices(spark, months)
    table.replace(spark, source if target is None else merge_daily(target, source), months)


def upsert_events(
    spark: SparkSession,
    table: SlicedTable,
    source: DataFrame,
    prune_range: tuple[dt.date, dt.date] | None = None,
) -> None:
    """Merge events; ``prune_range`` drops stale ones of the reprocessed dates.

    The source has one row per summary row, whose key the daily upsert has
    checked; an event adds its type to that key, so it is unique too.
    """
    source = written(spark, source.where(F.col("event_type").isNotNull()), "events")
    months = set(table.slices_in(source))
    prune = None
    if prune_range:
        start, end = prune_range
        months |= set(table.slices_in(table.read(spark, start, end)))
        prune = F.col("event_date").between(F.lit(start), F.lit(end))
    months = sorted(months)
    target = table.read_slices(spark, months)
    rows = source if target is None else merge_events(target, source, prune)
    table.replace(spark, rows, months)


def store_partials(
    spark: SparkSession, table: SlicedTable, partials: DataFrame, restated: DataFrame
) -> None:
    """Replace partial summaries of the documents in ``restated`` (city_name, document): their
    old rows go, also on dates that they no longer hold; other documents keep theirs."""
    restated = written(spark, restated.select("city_name", "document").distinct(), "restated")
    partials = written(spark, partials, "partials")
    old = table.read(spark).join(restated, ["city_name", "document"], "left_semi")
    slices = sorted({*table.slices_in(partials), *table.slices_in(old)})
    kept = table.read_slices(spark, slices)
    if kept is not None:
        partials = partials.unionByName(kept.join(restated, ["city_name", "document"], "left_anti"))
    table.replace(spark, partials, slices)


def run_silver(
    spark: SparkSession, lake: Lakehouse, documents: DataFrame, tolerant: bool = False
) -> None:
    incoming = to_silver(explode_hours(documents), tolerant)
    store_silver(spark, lake.silver, incoming, document_city_days(documents))


def run_gold(
    spark: SparkSession,
    lake: Lakehouse,
    start: dt.date,
    end: dt.date,
    as_of: dt.date,
    prune_stale: bool = False,
) -> None:
    """Daily summary and events of the Silver dates from ``start`` to ``end``.

    Events are read from the merged summary, so they carry its labels.
    """
    upsert_daily(spark, lake.daily, to_daily(lake.silver.read(spark, start, end), as_of))
    events = to_events(lake.daily.read(spark, start, end), as_of)
    upsert_events(spark, lake.events, events, (start, end) if prune_stale else None)


def landed_date() -> Column:
    """The date of a document's folder."""
    return F.concat_ws("-", "year", "month", "day").cast("date").alias("landed_date")


def staged_landing(spark: SparkSession, bronze: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """What landed, parsed once: a table of documents by ``outcome`` and the counts of each.

    Outcomes: ``good``; ``malformed``, what does not parse; ``no_city``, what names none;
    ``no_hours``, a document without its hourly block. All but the good ones carry their text.
    The counts are observed while the table is written.
    """
    parsed = F.to_json(F.struct(*[f.name for f in BRONZE.fields]))
    outcome = (
        F.when(F.col(CORRUPT_COLUMN).isNotNull(), "malformed")
        .when(F.col("city_name").isNull(), "no_city")
        .when(F.col("hourly").isNull(), "no_hours")
        .otherwise("good")
    )
    text = F.when(F.col("outcome") != "good", F.coalesce(F.col(CORRUPT_COLUMN), parsed))
    hours = F.coalesce(F.size("hourly.time"), F.lit(0))
    seen = Observation()
    rows = (
        bronze.withColumn("outcome", outcome)
        .withColumn("document", text)
        .drop(CORRUPT_COLUMN)
        .observe(
            seen,
            *[F.count_if(F.col("outcome") == name).alias(name) for name in ("good", "malformed", "no_city", "no_hours")],
            F.count_if((F.col("outcome") == "good") & (hours != HOURS_PER_DAY)).alias("short"),
        )
    )
    folder = new_folder(spark, "landing")
    rows.write.partitionBy("outcome").parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder), seen.get


def good(staged: DataFrame) -> DataFrame:
    return staged.where(F.col("outcome") == "good").drop("outcome", "document")


def malformed_rows(staged: DataFrame) -> DataFrame:
    return staged.where(F.col("outcome") != "good").select(
        landed_date(), "city", F.col("outcome").alias("reason"), "document"
    )


def reject_rows(documents: DataFrame) -> DataFrame:
    """Counts of rejected readings; one without a readable time is counted, not an error."""
    dated = documents.withColumn("landed_date", landed_date())
    return rejects(explode_hours(dated, "landed_date"), tolerant=True, carried=("landed_date",))


def run_quarantine(
    spark: SparkSession, lake: Lakehouse, staged: DataFrame, start: dt.date, end: dt.date
) -> DataFrame:
    """Store what is no document and what Silver leaves out; their counts per landed date,
    with those of good documents that do not hold one day of hours.

    The dates of the range are replaced, so a rerun after a repair clears them.
    """
    days = [str(start + dt.timedelta(days=i)) for i in range((end - start).days + 1)]
    documents = good(staged)
    lake.malformed.replace(spark, malformed_rows(staged), days)
    lake.rejects.replace(spark, reject_rows(documents), days)
    malformed = lake.malformed.read(spark, start, end).select("landed_date", F.lit("malformed").alias("what"), F.lit(1).cast("bigint").alias("n"))
    rejected = lake.rejects.read(spark, start, end).select("landed_date", F.lit("rejected").alias("what"), F.col("rejected").alias("n"))
    short = shape.hour_count_off(documents).select(landed_date(), F.lit("short").alias("what"), F.lit(1).cast("bigint").alias("n"))
    found = malformed.unionByName(rejected).unionByName(short)

    def total(what: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("what") == what, F.col("n"))), F.lit(0)).alias(what)

    return found.groupBy(F.col("landed_date").alias("expected_date")).agg(*[total(what) for what in QUARANTINED])


QUARANTINED = ["malformed", "rejected", "short"]


def run_range(
    spark: SparkSession,
    bronze_root: str,
    lake: Lakehouse,
    cities: DataFrame,
    start: dt.date,
    end: dt.date,
    as_of: dt.date,
    *,
    multi_line: bool = False,
    prune_stale: bool = False,
    require_coverage: bool = True,
) -> DataFrame:
    """Bronze to Gold for every city and date of the range, in one set of jobs.

    The landing is parsed once, into a table that all steps read. Fails when a city-date
    (a city, without ``require_coverage``) has no document that parses or a date has no
    Gold row; returns the status of each date, with the documents and readings that went to
    the quarantine tables before the gates, and the documents short of a day of hours.
    """
    staged, _ = staged_landing(spark, read_bronze(spark, bronze_root, start, end, multi_line=multi_line))
    documents = good(staged)
    quarantined = run_quarantine(spark, lake, staged, start, end)
    if require_coverage:
        coverage = gates.city_date_coverage(cities, documents, start, end)
    else:
        coverage = gates.city_coverage(cities, documents)
    gates.require_no_failure(coverage, "missing documents")
    run_silver(spark, lake, documents)
    run_gold(spark, lake, start, end, as_of, prune_stale)
    status = gates.gold_daily_status(
        lake.daily.read(spark, start, end), gates.date_grid(spark, start, end), cities.count()
    )
    gates.require_no_failure(status, "dates without Gold rows")
    return status.join(quarantined, "expected_date", "left").fillna(0, QUARANTINED)


def run_daily(
    spark: SparkSession, bronze_root: str, lake: Lakehouse, cities: DataFrame, today: dt.date,
    **options,
) -> DataFrame:
    """Yesterday, all cities."""
    start, end = gates.date_range(today, 1)
    return run_range(spark, bronze_root, lake, cities, start, end, today, **options)


def run_backfill(
    spark: SparkSession, bronze_root: str, lake: Lakehouse, cities: DataFrame, today: dt.date,
    days: int = BACKFILL_DAYS, **options,
) -> DataFrame:
    """The ``days`` full days before today; warns through the total row count."""
    start, end = gates.date_range(today, days)
    status = run_range(spark, bronze_root, lake, cities, start, end, today, **options)
    total = gates.gold_total_status(lake.daily.read(spark), days * cities.count())
    gates.require_no_failure(total, "Gold is empty")
    quarantined = status.agg(*[F.sum(what).alias(what) for what in QUARANTINED]).first()
    return total.withColumns({name: F.lit(n) for name, n in quarantined.asDict().items()})
