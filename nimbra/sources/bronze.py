"""Bronze: nested JSON documents partitioned by city, year, month, day.

A landing that is written here keeps each batch in a folder of its own and a manifest of the
city-days that it holds. The manifest is appended after the files are complete, and the last
batch of a city-day is the one that counts: nothing is deleted or overwritten, no folder is
listed to find documents, and a batch that failed half-way is never seen. A landing of
another writer, without manifest, is read by its folders.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nimbra.schemas import BRONZE, BRONZE_PARTITIONS, CORRUPT_COLUMN, bronze_read_schema, struct
from nimbra.sources.sql_tables import create_table, point_partitions

_MANIFEST = struct(
    sequence="bigint", city="string", year="string", month="string", day="string",
    path="string", files="bigint", length="bigint",
)


def _missing_is_none(load: Callable[[], DataFrame]) -> DataFrame | None:
    try:
        return load()
    except AnalysisException as problem:
        if _none_found(problem):
            return None
        raise


def manifest(
    spark: SparkSession, root: str, start: dt.date | None = None, end: dt.date | None = None
) -> DataFrame | None:
    """The current entry of every city-day (of the range, if given); None without a manifest."""
    entries = _missing_is_none(lambda: spark.read.schema(_MANIFEST).json(f"{root}/manifest"))
    if entries is None:
        return None
    wanted = F.lit(True) if start is None or end is None else in_date_range(start, end)
    about = F.max_by(F.struct("path", "files", "length"), "sequence").alias("last")
    return entries.where(wanted).groupBy(*BRONZE_PARTITIONS).agg(about).select(*BRONZE_PARTITIONS, "last.*")


def documents_root(spark: SparkSession, root: str) -> str:
    """Where the documents of a landing are, for readers that go by folders."""
    return root if manifest(spark, root) is None else f"{root}/documents"


def _load(
    spark: SparkSession, reader: DataFrameReader, root: str, start: dt.date | None, end: dt.date | None
) -> DataFrame | None:
    """What ``reader`` finds: the folders that the manifest names, one for each city-day."""
    entries = manifest(spark, root, start, end)
    if entries is None:
        found = _missing_is_none(lambda: reader.load(root)) if start else reader.load(root)
        return found if found is None or start is None or end is None else found.where(in_date_range(start, end))
    paths = [row["path"] for row in entries.select("path").collect()]
    return reader.option("basePath", f"{root}/documents").load(paths).drop("batch") if paths else None


def _none_found(problem: AnalysisException) -> bool:
    return problem.getCondition() == "PATH_NOT_FOUND"


def read_bronze(
    spark: SparkSession,
    root: str,
    start: dt.date | None = None,
    end: dt.date | None = None,
    *,
    multi_line: bool = False,
    variables: list[str] | None = None,
) -> DataFrame:
    """Documents under ``root``, of the dates from ``start`` to ``end`` if given.

    Partition values stay zero-padded text. ``multi_line`` reads pretty-printed
    landings, one document per file. Our own writer emits a document per line,
    which Spark can split. Malformed documents do not fail the read, they carry
    their text in the corrupt column.
    """
    schema = bronze_read_schema(variables)
    reader = (
        spark.read.format("json")
        .schema(schema)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .option("allowNonNumericNumbers", False)
    )
    found = _load(spark, reader, root, start, end)
    return spark.createDataFrame([], schema) if found is None else found


def _is_document() -> Column:
    """Parses and names its city.

    A line of a pretty-printed document can be valid JSON by itself, and only
    the city name tells that it is no document.
    """
    return F.col(CORRUPT_COLUMN).isNull() & F.col("city_name").isNotNull()


def good_documents(bronze: DataFrame) -> DataFrame:
    return bronze.where(_is_document()).drop(CORRUPT_COLUMN)


def malformed_documents(bronze: DataFrame) -> DataFrame:
    """Quarantine: the text of what is no document, with its partition.

    What parses but names no city is written as JSON again.
    """
    parsed = F.to_json(F.struct(*[f.name for f in BRONZE.fields if f.name in bronze.columns]))
    return bronze.where(~_is_document()).select(
        *BRONZE_PARTITIONS, F.coalesce(F.col(CORRUPT_COLUMN), parsed).alias("document")
    )


def landed_files(
    spark: SparkSession, root: str, start: dt.date | None = None, end: dt.date | None = None
) -> DataFrame:
    """City-days that hold anything, with path and length: from the manifest, or one row for
    each non-empty file of a landing without one. Content is not read."""
    entries = manifest(spark, root, start, end)
    if entries is None:
        keys = struct(**{k: "string" for k in BRONZE_PARTITIONS})
        reader = spark.read.schema(T.StructType([*_FILE.fields, *keys.fields])).format("binaryFile")
        entries = _load(spark, reader, root, start, end)
        if entries is None:
            return spark.createDataFrame([], T.StructType([*keys.fields, *_FILE.fields[::2]]))
    return entries.where(F.col("length") > 0).select(*BRONZE_PARTITIONS, "path", "length")


_FILE = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)


def partition_text(date: Column) -> dict[str, Column]:
    """Zero-padded year, month and day of a date."""
    return {
        "year": F.date_format(date, "yyyy"),
        "month": F.date_format(date, "MM"),
        "day": F.date_format(date, "dd"),
    }


def in_date_range(start: dt.date, end: dt.date) -> Column:
    """Partition filter for whole days from ``start`` to ``end``.

    Made of comparisons of the text partition columns with literals only, so
    it is decided from the directory names.
    """
    year, month, day = F.col("year"), F.col("month"), F.col("day")
    key = F.concat(year, month, day)
    return (
        year.between(f"{start:%Y}", f"{end:%Y}")
        & key.between(f"{start:%Y%m%d}", f"{end:%Y%m%d}")
    )


def write_bronze(documents: DataFrame, root: str) -> None:
    """Land ``documents``: they are the city-days that they hold from now on; others stay.

    The rebalance gives a small city-day one file and splits a large one over
    several tasks. One writer at a time.
    """
    spark = documents.sparkSession
    batch = f"{root}/documents/batch={uuid.uuid4().hex}"
    (
        documents.select(*[F.col(f.name) for f in BRONZE.fields], *BRONZE_PARTITIONS)
        .hint("rebalance", *BRONZE_PARTITIONS)
        .write.partitionBy(*BRONZE_PARTITIONS)
        .json(batch)
    )
    record_batch(spark, root, batch)


def record_batch(spark: SparkSession, root: str, batch: str) -> None:
    """Append the city-days in the folder ``batch`` to the manifest of ``root``; from here on
    readers see them. The folder is listed, its files are not read."""
    files = landed_files(spark, batch)
    entries = files.groupBy(*BRONZE_PARTITIONS).agg(
        F.min(F.regexp_replace("path", "/[^/]*$", "")).alias("path"),
        F.count("*").alias("files"),
        F.sum("length").alias("length"),
    )
    known = _missing_is_none(lambda: spark.read.schema(_MANIFEST).json(f"{root}/manifest"))
    last = 0 if known is None else known.agg(F.max("sequence")).first()[0] or 0
    entries.select(F.lit(last + 1).cast("bigint").alias("sequence"), *_MANIFEST.fieldNames()[1:]).coalesce(1).write.mode(
        "append"
    ).json(f"{root}/manifest")


def register_bronze(spark: SparkSession, database: str, table: str, root: str) -> None:
    """SQL access to a landing: the table ``table`` of all that landed, whose partitions follow
    the manifest (or the folders, without one), and the view ``table``_documents of what is a
    document. Both are created if absent; calling again picks up what has landed since."""
    fields = [f for f in bronze_read_schema().fields if f.name not in BRONZE_PARTITIONS]
    options = {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN, "allowNonNumericNumbers": "false",
    }
    entries = manifest(spark, root)
    name = f"{database}.{table}"
    create_table(spark, name, T.StructType(fields), BRONZE_PARTITIONS, "json", root, options)
    if entries is None:
        spark.catalog.recoverPartitions(name)
    else:
        current = {tuple(row[k] for k in BRONZE_PARTITIONS): row["path"] for row in entries.collect()}
        point_partitions(spark, name, BRONZE_PARTITIONS, current)
    columns = ", ".join(f.name for f in [*BRONZE.fields]) + ", " + ", ".join(BRONZE_PARTITIONS)
    spark.sql(
        f"CREATE OR REPLACE VIEW {name}_documents AS SELECT {columns} FROM {name} "
        f"WHERE {CORRUPT_COLUMN} IS NULL AND city_name IS NOT NULL"
    )
