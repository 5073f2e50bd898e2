"""Streaming form of the daily summary over an append-only Bronze landing.

No state is kept between batches and no watermark drops what comes late: each batch stores
partial summaries of its documents, and the city-days that it touches are merged again from
the stored ones, whatever their age.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from nimbra.operators.daily import partial_schema, partial_summaries, summary_of_partials
from nimbra.operators.silver import explode_hours, to_silver
from nimbra.plans.runs import Lakehouse, good, malformed_rows, reject_rows, staged_landing, upsert_daily
from nimbra.schemas import CORRUPT_COLUMN, bronze_read_schema
from nimbra.sources.bronze import documents_root


def read_landing(
    spark: SparkSession,
    root: str,
    files_per_batch: int | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Documents, and what is none, as their files appear, read as ``read_bronze`` reads them.

    A file is read once per path: a document overwritten at its old path is
    not seen again, so restatements need the batch run.
    """
    reader = (
        spark.readStream.schema(bronze_read_schema())
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .option("allowNonNumericNumbers", False)
        .option("multiLine", multi_line)
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(documents_root(spark, root)).drop("batch")


def _store(rows: DataFrame, root: str, number: int, *by: str) -> DataFrame:
    """A batch has a folder of its own in ``stream`` of a table; repeated, it overwrites that."""
    folder = f"{root}/stream/batch={number}"
    rows.write.mode("overwrite").partitionBy(*by).parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def _store_quarantine(staged: DataFrame, lake: Lakehouse, number: int) -> None:
    _store(malformed_rows(staged), lake.malformed.root, number)
    _store(reject_rows(good(staged)), lake.rejects.root, number)


def _drained(landing: DataFrame, checkpoint: str, batch_to) -> StreamingQuery:
    return (
        landing.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(batch_to)
        .trigger(availableNow=True)
        .start()
    )


def stream_quarantine(
    spark: SparkSession,
    landing: str,
    lake: Lakehouse,
    checkpoint: str,
    *,
    files_per_batch: int | None = None,
    multi_line: bool = False,
) -> StreamingQuery:
    """Store what is no document and what Silver leaves out, and nothing else, until the
    landing is drained. A lake has one checkpoint."""

    def store(batch: DataFrame, number: int) -> None:
        _store_quarantine(staged_landing(batch.sparkSession, batch)[0], lake, number)

    return _drained(read_landing(spark, landing, files_per_batch, multi_line), checkpoint, store)


def stream_daily(
    spark: SparkSession,
    landing: str,
    lake: Lakehouse,
    checkpoint: str,
    as_of: dt.date,
    *,
    files_per_batch: int | None = None,
    multi_line: bool = False,
) -> StreamingQuery:
    """Keep the daily summary current with the landing, until it is drained.

    A batch is parsed once. It stores its quarantine, its Silver rows and their partial
    summaries, each in a folder of its number, so a batch that is repeated after a failure
    writes the same again. The city-days with new partial rows are then merged from all
    batches and upserted: documents of a city-day may come in different batches, months apart.
    """

    def store(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        staged, _ = staged_landing(spark, batch)
        _store_quarantine(staged, lake, number)
        silver = _store(to_silver(explode_hours(good(staged))), lake.silver.root, number)
        new = _store(partial_summaries(silver), lake.partials.root, number, "weather_date")
        touched = new.select("city_name", "weather_date").distinct()
        dates = [row[0] for row in touched.select("weather_date").distinct().collect()]
        stored = spark.read.schema(partial_schema()).option("basePath", f"{lake.partials.root}/stream")
        partials = stored.parquet(f"{lake.partials.root}/stream").where(F.col("weather_date").isin(dates))
        upsert_daily(spark, lake.daily, summary_of_partials(partials.join(touched, ["city_name", "weather_date"], "left_semi"), as_of))

    return _drained(read_landing(spark, landing, files_per_batch, multi_line), checkpoint, store)


def stream_silver(spark: SparkSession, lake: Lakehouse) -> DataFrame:
    """The readings that all batches of the stream have kept."""
    return spark.read.schema(lake.silver.schema).parquet(f"{lake.silver.root}/stream/*")
