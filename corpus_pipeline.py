"""From raw documents to packed training sequences: four stages, each over all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from nimbra.llm import op2_simhash, op6_quality_rules, op8_quality_classifier, op10_packing
from nimbra.llm.common import materialize, table

#: (name, function of (spark, docs, sf_dir)). All but the last return the columns of ``docs``.
STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", op6_quality_rules.stage),
    ("quality_classifier", op8_quality_classifier.stage),
    ("simhash_near_dedup", op2_simhash.stage),
    ("packing", op10_packing.stage),
]

#: The classifier is a trained model and packing an algorithm of many steps: not for SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
