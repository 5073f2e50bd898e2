"""Helpers shared by the operators of this package."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from nimbra.scratch import new_folder

#: A word is a run of characters other than the space and U+0009 to U+000D.
WORD_SPACE = r"[\x20\x09-\x0D]+"

#: Texts are handled in slices of about this many bytes, whatever an Arrow batch holds.
SLICE_BYTES = 8 << 20

#: Rows of a range of a sorted table, about.
ROWS_OF_PART = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts the lineage and
    makes what follows independent of lost executors."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold_of(doc_id: str, folds: int):
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds


def lower_ascii(column):
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


#: str.split() also splits at other Unicode spaces, so it may only be used where none occur.
_OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_SPACES = re.compile(WORD_SPACE)


def words_of(text: str) -> list[str]:
    """The words of a text, in order."""
    if _OTHER_SPACE.search(text) is None:
        return text.split()
    return [word for word in _SPACES.split(text) if word]


def lower(text: str) -> str:
    """A-Z to a-z, nothing else."""
    if text.isascii():
        return text.lower()
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # of bytes: ASCII alone


def slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each has about SLICE_BYTES of ``column``, one row at least."""
    for batch in batches:
        lengths = batch.column(batch.schema.get_field_index(column))
        sizes = np.asarray(pc.fill_null(pc.binary_length(lengths), 0))
        group = np.cumsum(sizes, dtype=np.int64) // SLICE_BYTES
        starts = np.flatnonzero(np.diff(group, prepend=-1))
        for start, end in zip(starts, [*starts[1:], len(sizes)], strict=True):
            if end > start:
                yield batch.slice(start, end - start)


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts of a batch; null reads as empty."""
    return [text or "" for text in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def map_arrow(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    return df.mapInArrow(function, schema)


def ranked(df: DataFrame, group: str, order: list[str], rank: str, size: str) -> DataFrame:
    """Adds the place of every row within its ``group`` (from 0, nulls first; rows that tie
    in ``order`` take some order among them) and the rows of the group.

    Rows are dealt to ranges of (group, order), so a group of any size spreads over tasks;
    only counts by range and group are added up. The columns ``part`` and ``at`` are used up.
    """
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // ROWS_OF_PART))
    keys = [group, *order]
    place = F.monotonically_increasing_id()
    sorted_rows = materialize(
        df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumns(
            {"part": F.shiftright(place, 33), "at": place.bitwiseAND((1 << 33) - 1)}
        ),
        "ranked",
    )
    before = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = sorted_rows.groupBy(group, "part").agg(F.count("*").alias("rows"), F.min("at").alias("first"))
    ranges = counts.select(
        F.col(group).alias("range group"),
        F.col("part").alias("range part"),
        (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("offset"),
        F.sum("rows").over(Window.partitionBy(group)).alias(size),
    )
    same = F.col(group).eqNullSafe(F.col("range group")) & (F.col("part") == F.col("range part"))
    return (
        sorted_rows.join(ranges, same, "left")
        .withColumn(rank, F.col("at") + F.col("offset"))
        .drop("part", "at", "range group", "range part", "offset")
    )
