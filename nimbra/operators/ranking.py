"""Competition rank (ties share, gaps follow) without gathering a partition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rank_descending(
    rows: DataFrame, value: str, name: str, within: list[str], bucket_width: float | None = None
) -> DataFrame:
    """``rank() over (partition by within order by value desc nulls last)``.

    A rank window brings every row of a partition to one task. Here rows are
    first reduced to (value, count), which makes any number of ties one row; the
    running count of higher values gives the rank, which is joined back.

    Where a partition may hold too many distinct values for one task, they are
    cut into buckets of ``bucket_width``: a rank is then 1 + the rows of higher
    buckets + the rows of higher values in the same bucket, and no task sees
    more than the distinct values of one bucket, or one row per bucket.
    """
    counts = rows.groupBy(*within, value).agg(F.count("*").alias("tied"))
    if bucket_width:
        counts = counts.withColumn("bucket", F.floor(F.col(value) / F.lit(float(bucket_width))))
        ranks = _ranks_by_bucket(counts, value, within)
    else:
        ranks = counts.withColumn("higher", _running("tied", within, value))
    keys = [*within, value]
    places = ranks.select(
        *[F.col(k).alias(f"rank_{k}") for k in keys], (F.col("higher") + 1).cast("int").alias(name)
    )
    back = [F.col(k).eqNullSafe(F.col(f"rank_{k}")) for k in keys]
    return rows.join(places, back).drop(*[f"rank_{k}" for k in keys])


def _running(amount: str, within: list[str], value: str) -> Column:
    """Sum of ``amount`` over the higher values of a partition."""
    higher = (
        Window.partitionBy(*within)
        .orderBy(F.col(value).desc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return F.coalesce(F.sum(amount).over(higher), F.lit(0))


def _ranks_by_bucket(counts: DataFrame, value: str, within: list[str]) -> DataFrame:
    buckets = (
        counts.groupBy(*within, "bucket")
        .agg(F.sum("tied").alias("in_bucket"))
        .withColumn("above", _running("in_bucket", within, "bucket"))
    )
    ahead = counts.withColumn("ahead", _running("tied", [*within, "bucket"], value))
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in [*within, "bucket"]]
    return (
        ahead.alias("a")
        .join(buckets.alias("b"), same)
        .select(
            *[F.col(f"a.{k}") for k in [*within, value]],
            (F.col("above") + F.col("ahead")).alias("higher"),
        )
    )
