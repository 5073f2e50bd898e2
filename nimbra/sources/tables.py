"""Silver and Gold tables: Parquet partitions replaced in one atomic step.

A replaced partition is written to a new version folder first. One appended
line file in the table's log then makes all partitions of that version current
at once; before it appears readers see the old ones, and a failed or repeated
write leaves nothing behind but an unused folder. Plain Parquet has no MERGE,
and overwriting in place could lose the only copy of the target.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nimbra.operators.daily import partial_schema
from nimbra.schemas import GOLD_DAILY, GOLD_EVENTS, SILVER, struct
from nimbra.sources.sql_tables import create_table, point_partitions

SLICE = "slice"
MALFORMED = struct(landed_date="date", city="string", reason="string", document="string")
REJECTS = struct(
    landed_date="date", city_name="string", observation_date="date", rejected="bigint",
    no_temperature="bigint", no_humidity="bigint", no_wind="bigint", no_time="bigint",
)
_LOG = struct(sequence="bigint", slice="string", version="string", filled="boolean")


@dataclass(frozen=True)
class SlicedTable:
    """A table cut by a text slice of its date: one per day or per month."""

    root: str
    schema: T.StructType
    date_column: str
    slice_format: str
    order: tuple[str, ...]
    #: Name of the catalog table that follows the current versions, if there is one.
    catalog_name: str | None = None

    def slice_of(self, date: Column) -> Column:
        return F.date_format(date, self.slice_format)

    def _log(self, spark: SparkSession) -> DataFrame | None:
        try:
            return spark.read.schema(_LOG).json(f"{self.root}/log")
        except AnalysisException as missing:
            if missing.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def _current(self, spark: SparkSession, keep: Column) -> DataFrame | None:
        """Rows of the current versions of the slices that ``keep`` selects, if any.

        The driver sees one line per slice (a day or a month), never rows.
        """
        folders = [f for f in self._folders(spark, keep).values() if f]
        return spark.read.schema(self.schema).parquet(*folders) if folders else None

    def _folders(self, spark: SparkSession, keep: Column) -> dict[str, str | None]:
        """The folder of the current version of each slice; None where that is empty."""
        log = self._log(spark)
        if log is None:
            return {}
        last = F.max_by(F.struct("version", "filled"), "sequence").alias("last")
        current = log.where(keep).groupBy(SLICE).agg(last).select(SLICE, "last.*").collect()
        return {
            r[SLICE]: f"{self.root}/data/version={r.version}/{SLICE}={r[SLICE]}" if r.filled else None
            for r in current
        }

    def create_table(self, spark: SparkSession) -> None:
        """Create the catalog table if absent and point it to the current versions."""
        create_table(spark, self.catalog_name, self.schema, [SLICE], "parquet", f"{self.root}/data")
        self.publish(spark, F.lit(True))

    def publish(self, spark: SparkSession, keep: Column) -> None:
        """Let the catalog table, if there is one, read the current versions of these slices."""
        if self.catalog_name and spark.catalog.tableExists(self.catalog_name):
            folders = {(name,): folder for name, folder in self._folders(spark, keep).items()}
            point_partitions(spark, self.catalog_name, [SLICE], folders)

    def read(
        self, spark: SparkSession, start: dt.date | None = None, end: dt.date | None = None
    ) -> DataFrame:
        """Current rows, optionally of the dates from ``start`` to ``end``."""
        rows_of, slices_of = F.lit(True), F.lit(True)
        if start:
            slices_of &= F.col(SLICE) >= self.slice_of(F.lit(start))
            rows_of &= F.col(self.date_column) >= F.lit(start)
        if end:
            slices_of &= F.col(SLICE) <= self.slice_of(F.lit(end))
            rows_of &= F.col(self.date_column) <= F.lit(end)
        rows = self._current(spark, slices_of)
        return spark.createDataFrame([], self.schema) if rows is None else rows.where(rows_of)

    def read_slices(self, spark: SparkSession, slices: list[str]) -> DataFrame | None:
        """Current rows of ``slices``, whole; None where the table has none of them."""
        return self._current(spark, F.col(SLICE).isin(slices))

    def stage(self, spark: SparkSession, rows: DataFrame) -> Version:
        """Write ``rows`` to a new version, which no reader sees before its commit."""
        version = Version(self, uuid.uuid4().hex)
        version.add(rows)
        return version

    def replace(self, spark: SparkSession, rows: DataFrame, slices: list[str]) -> None:
        """Make ``rows`` the whole content of ``slices``; other slices stay."""
        if slices:
            self.stage(spark, rows).commit(spark, slices)

    def slices_in(self, rows: DataFrame) -> list[str]:
        """Slices that ``rows`` touch: at most one per calendar day or month."""
        found = rows.select(self.slice_of(F.col(self.date_column)).alias(SLICE)).distinct()
        return sorted(r[SLICE] for r in found.where(F.col(SLICE).isNotNull()).collect())


@dataclass(frozen=True)
class Version:
    """A version folder of a table, before or after it is made current."""

    table: SlicedTable
    name: str

    @property
    def folder(self) -> str:
        return f"{self.table.root}/data/version={self.name}"

    def add(self, rows: DataFrame) -> None:
        """Append rows, one set of files per slice.

        The rebalance merges small slices and splits large ones over tasks.
        """
        table = self.table
        sliced = rows.select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema.fields],
            table.slice_of(F.col(table.date_column)).alias(SLICE),
        )
        (
            sliced.hint("rebalance", SLICE)
            .sortWithinPartitions(SLICE, *table.order)
            .write.mode("append")
            .partitionBy(SLICE)
            .parquet(self.folder)
        )

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.table.schema).parquet(self.folder)

    def slices(self, spark: SparkSession) -> list[str]:
        """Slices that hold rows, from the folder names and file footers alone."""
        found = spark.read.schema(struct(slice="string")).parquet(self.folder).distinct()
        return sorted(r[SLICE] for r in found.collect())

    def commit(self, spark: SparkSession, slices: list[str]) -> None:
        """Make this version the current one of ``slices``, all at once.

        A slice without rows in it becomes empty. One writer at a time.
        """
        filled = set(self.slices(spark))
        log = self.table._log(spark)
        last = 0 if log is None else log.agg(F.max("sequence")).first()[0] or 0
        entries = [(last + 1, s, self.name, s in filled) for s in sorted({*slices, *filled})]
        spark.createDataFrame(entries, _LOG).coalesce(1).write.mode("append").json(
            f"{self.table.root}/log"
        )
        self.table.publish(spark, F.col(SLICE).isin([s for _, s, *_ in entries]))


def silver_table(root: str) -> SlicedTable:
    """One slice per observation date."""
    return SlicedTable(
        f"{root}/silver_hourly", SILVER, "observation_date", "yyyy-MM-dd",
        ("city_name", "observation_timestamp"),
    )


def gold_daily_table(root: str, slice_format: str = "yyyy-MM") -> SlicedTable:
    """One slice per month, so an upsert rewrites the months it touches.

    With very many cities a slice per day (``yyyy-MM-dd``) keeps a daily run
    from rewriting the month; the choice is for the life of the table.
    """
    return SlicedTable(
        f"{root}/gold_daily_summary", GOLD_DAILY, "weather_date", slice_format,
        ("weather_date", "city_name"),
    )


def gold_events_table(root: str, slice_format: str = "yyyy-MM") -> SlicedTable:
    return SlicedTable(
        f"{root}/gold_extreme_events", GOLD_EVENTS, "event_date", slice_format,
        ("event_date", "city_name"),
    )


def malformed_table(root: str) -> SlicedTable:
    """What is no document, with its text; one slice per date of the landing."""
    return SlicedTable(f"{root}/quarantine_malformed", MALFORMED, "landed_date", "yyyy-MM-dd", ("city",))


def rejects_table(root: str) -> SlicedTable:
    """Counts of the readings that Silver leaves out; one slice per date of the landing."""
    return SlicedTable(f"{root}/quarantine_rejects", REJECTS, "landed_date", "yyyy-MM-dd", ("city_name",))


def partials_table(root: str) -> SlicedTable:
    """Partial summaries of documents, by the text ``document``; one slice per date."""
    return SlicedTable(f"{root}/gold_partials", partial_schema("document"), "weather_date", "yyyy-MM-dd", ("city_name",))
