"""Column-level MERGE of a source into a target, as a full outer join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nimbra.operators import daily, events
from nimbra.schemas import GOLD_DAILY, GOLD_EVENTS

# Set on insert only: a match keeps what the target has.
STICKY_DAILY = ["city_display_name", "country", "first_seen_date"]
STICKY_EVENTS = ["city_display_name", "country", "detected_on"]


def duplicate_keys(source: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that more than one source row claims: a MERGE needs one at most."""
    return source.groupBy(*keys).agg(F.count("*").alias("source_rows")).where("source_rows > 1")


class DuplicateKeys(ValueError):
    pass


def require_unique(source: DataFrame, keys: list[str]) -> None:
    claimed = duplicate_keys(source, keys)
    found = claimed.take(5)
    if found:
        raise DuplicateKeys(
            f"several source rows for one key: {claimed.count()} keys, such as {[r.asDict() for r in found]}"
        )


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    sticky: list[str],
    drop_unmatched: Column | None = None,
) -> DataFrame:
    """Rows of ``target`` after the MERGE.

    A matched row takes every column from the source except the ``sticky``
    ones, an unmatched source row is inserted whole, an unmatched target row
    stays unless ``drop_unmatched`` (a test on target columns) holds for it.
    """
    columns = target.columns
    old = target.select(*[F.col(c) if c in keys else F.col(c).alias(f"old_{c}") for c in columns],
                        F.lit(True).alias("in_target"))
    new = source.select(*[F.col(c) if c in keys else F.col(c).alias(f"new_{c}") for c in columns],
                        F.lit(True).alias("in_source"))
    hit_old, hit_new = F.col("in_target").isNotNull(), F.col("in_source").isNotNull()

    def merged(name: str) -> Column:
        if name in keys:
            return F.col(name)
        old_value, new_value = F.col(f"old_{name}"), F.col(f"new_{name}")
        if name in sticky:
            return F.when(hit_old, old_value).otherwise(new_value).alias(name)
        return F.when(hit_new, new_value).otherwise(old_value).alias(name)

    joined = old.join(new, keys, "full_outer")
    result = joined.select(*[merged(c) for c in columns], hit_new.alias("in_source"))
    if drop_unmatched is not None:
        result = result.where(F.col("in_source") | ~F.coalesce(drop_unmatched, F.lit(False)))
    return result.select(columns)


def merge_daily(target: DataFrame, source: DataFrame) -> DataFrame:
    return merge(target.select(GOLD_DAILY.fieldNames()), source, daily.KEYS, STICKY_DAILY)


def merge_events(
    target: DataFrame, source: DataFrame, prune_stale: Column | None = None
) -> DataFrame:
    """Merge classified events; unclassified source rows take no part.

    By default an event stays when its day is reprocessed into another type or
    none. ``prune_stale`` tells which reprocessed target rows to drop then.
    """
    classified = source.where(F.col("event_type").isNotNull())
    return merge(
        target.select(GOLD_EVENTS.fieldNames()), classified, events.KEYS, STICKY_EVENTS, prune_stale
    )
