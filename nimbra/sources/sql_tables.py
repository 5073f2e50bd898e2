"""Catalog tables over folders that change: partitions are pointed to where the rows are."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

#: Partitions added by one statement.
_AT_ONCE = 200


def create_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    keys: list[str],
    kind: str,
    location: str,
    options: dict[str, str] | None = None,
) -> None:
    """Create database and external table if absent, partitioned by the text columns ``keys``."""
    database = name.rpartition(".")[0]
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields]
    columns += [f"`{key}` string" for key in keys]
    given = ", ".join(f"'{k}' '{v}'" for k, v in (options or {}).items())
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(columns)}) USING {kind} "
        + (f"OPTIONS ({given}) " if given else "")
        + f"PARTITIONED BY ({', '.join(keys)}) LOCATION '{location}'"
    )


def _specification(keys: list[str], values: tuple[str, ...]) -> str:
    return "PARTITION (" + ", ".join(f"`{k}` = '{v}'" for k, v in zip(keys, values, strict=True)) + ")"


def known_partitions(spark: SparkSession, name: str) -> set[tuple[str, ...]]:
    found = spark.sql(f"SHOW PARTITIONS {name}").collect()
    return {tuple(part.partition("=")[2] for part in row[0].split("/")) for row in found}


def point_partitions(
    spark: SparkSession, name: str, keys: list[str], locations: dict[tuple[str, ...], str | None]
) -> None:
    """Make each partition read from its location; one with None has no rows any more."""
    known = known_partitions(spark, name)
    added = [
        f"{_specification(keys, values)} LOCATION '{path}'"
        for values, path in sorted(locations.items()) if path is not None and values not in known
    ]
    for at in range(0, len(added), _AT_ONCE):
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(added[at : at + _AT_ONCE])}")
    for values, path in sorted(locations.items()):
        if values in known:
            change = f"DROP IF EXISTS {_specification(keys, values)}"
            if path is not None:
                change = f"{_specification(keys, values)} SET LOCATION '{path}'"
            spark.sql(f"ALTER TABLE {name} {change}")
    spark.catalog.refreshTable(name)
