from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

HARD = [
    (4, None),
    (2, ""),
    (7, " \t\n"),
    (1, "The cat sat. The cat sat!\n\nThe cat sat. The cat sat!\nä 中文 🙂 don't  stop\r\nx"),
    (3, "The cat sat. The cat sat!\n\nThe cat sat. The cat sat!\nä 中文 🙂 don't  stop\r\nx"),
    (None, "a row without an id, in words"),
    (5, "word " * 30_000 + "y" * 5_000),
    (6, "repeated row"),
    (6, "repeated row"),
]


@pytest.fixture
def hard(spark: SparkSession):
    """Nulls, empty and very long texts, ties, repeated rows, columns with names that operators use."""
    rows = [(i, t, "row", 1.5, [1], "x", "kept") for i, t in HARD]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, row string, score double, ids array<int>, key string, label string"
    ).repartition(3)


@pytest.fixture
def nothing(hard):
    return hard.limit(0)
