"""Exact duplicates by progressive refinement, in DataFrame functions alone.

Documents are grouped by length, then by a hash of their first characters, then by a hash
of all of them; each step looks only at what the step before left in groups of two or more.
What survives a step is remembered by buckets of its keys, of which there are at most
``BUCKETS``: a set of bounded size that goes to every task, so no text is moved. Keys that
share a bucket with a surviving one are looked at again by the next step, which tells them
apart, so the buckets cost time at most and never a result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from nimbra.llm.common import materialize, table

#: Characters that the second step reads.
PREFIX_CHARS = 256
#: Surviving keys are told to the tasks as at most this many numbers.
BUCKETS = 1 << 20

CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def normalised(text: Column) -> Column:
    """A-Z to a-z and nothing else; null is empty. ``lower`` is the same, and faster, where all is ASCII."""
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, CAPITALS, CAPITALS.lower())
    )


def _bucket(*keys: Column) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS))


def _surviving(keyed: DataFrame, *keys: str) -> DataFrame:
    """Buckets of the keys that two or more rows have; at most BUCKETS rows."""
    repeated = keyed.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    return materialize(repeated.select(_bucket(*[F.col(k) for k in keys]).alias("bucket")).distinct(), "dedup-buckets")


def classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    carried: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept and the ``carried`` columns.

    Texts are equal when they are identical after lower-casing A-Z; null counts as empty, so
    null and empty texts are one group. Of a group the row with the largest id is kept, null
    being the least; of rows that repeat that id, one. Rows with a null id take part like
    others. Names of other columns do not matter. An empty table gives no rows.
    """
    carried = carried or {}
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"),
        text.alias("text"),
        F.octet_length(text).alias("length"),
        F.struct(F.lit(None).cast("boolean").alias("none"), *[c.alias(name) for name, c in carried.items()]).alias("carried"),
    )
    lengths = _surviving(rows, "length")
    prefix = F.xxhash64(normalised(F.substring("text", 1, PREFIX_CHARS)))
    of_length = rows.join(F.broadcast(lengths), _bucket(F.col("length")) == F.col("bucket"), "left_semi")
    prefixes = _surviving(of_length.select("length", prefix.alias("prefix")), "length", "prefix")
    # the whole text is hashed only where length and prefix have another row
    full = F.when(F.col("bucket").isNotNull(), F.sha2(normalised(F.col("text")), 256))
    hashed = materialize(
        rows.withColumn("prefix", prefix)
        .join(F.broadcast(prefixes), _bucket(F.col("length"), F.col("prefix")) == F.col("bucket"), "left")
        .select("id", "carried", "length", full.alias("full"), F.monotonically_increasing_id().alias("row")),
        "dedup-hashes",
    )
    several = hashed.where(F.col("full").isNotNull())
    # A table of groups, one row each: between two tables Spark splits the rows of a large
    # group over tasks, which it does not where an aggregate stands below the join.
    groups = materialize(
        several.groupBy("length", "full")
        .agg(F.count("*").alias("group_size"), F.max(F.struct("id", "row")).alias("top"))
        .where("group_size > 1"),
        "dedup-groups",
    )
    joined = several.join(groups, ["length", "full"], "left")
    alone = hashed.where(F.col("full").isNull()).withColumns(
        {"group_size": F.lit(None).cast("bigint"), "top": F.struct("id", "row")}
    )
    return joined.unionByName(alone).select(
        F.col("id").alias(id_col),
        F.when(F.col("top").isNull(), F.col("id")).otherwise(F.col("top.id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        F.coalesce(F.col("top.row") == F.col("row"), F.lit(True)).alias("kept"),
        *[F.col("carried")[name].alias(name) for name in carried],
    )


def keep_last(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    whole = {"row": F.struct(*[F.col(f"`{name}`") for name in docs.columns])}
    kept = classes(docs, id_col, text_col, whole).where("kept")
    return kept.select(*[F.col("row")[name].alias(name) for name in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = {"text_sha256": F.sha2(normalised(F.col("text")), 256)}
    return classes(table(spark, sf_dir, "documents"), carried=digest)


ORACLE = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, text_sha256
FROM (
  SELECT doc_id, sha256(translate(COALESCE(text, ''),
                                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents
)
WINDOW same AS (PARTITION BY text_sha256)
"""
