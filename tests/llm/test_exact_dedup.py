from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from nimbra.llm import op12_exact_dedup as dedup
from tests.llm.conftest import HARD

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(rows) -> list[tuple]:
    """(id, keep_id, group_size, digest); which of equal ids is kept is tested apart."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[(text or "").translate(LOWER)].append(doc_id)
    out = []
    for text, ids in groups.items():
        top = max((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, top, len(ids), digest) for i in ids]
    return sorted(out, key=repr)


def check(docs, rows):
    digest = {"text_sha256": F.sha2(dedup.normalised(F.col("text")), 256)}
    got = dedup.classes(docs, carried=digest).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=repr) == expected(rows)
    kept = [r for r in got if r.kept]
    assert all(r.doc_id == r.keep_id for r in kept)
    assert len(kept) == len({r.text_sha256 for r in got})  # one row of each group


def test_hard_rows(hard):
    check(hard, HARD)


def test_same_start_same_length_and_case(spark):
    base = "Word " * 100
    rows = [(1, base + "a"), (2, base + "b"), (3, base.upper() + "A"), (4, base + "c" * 3)]
    rows += [(5, "Straße É"), (6, "straße É"), (7, "straße é"), (8, "K"), (9, "k"), (10, "K")]
    check(spark.createDataFrame(rows, "doc_id bigint, text string"), rows)


@pytest.mark.parametrize("buckets", [1, 7, 1 << 20])
def test_buckets_change_no_result(spark, monkeypatch, buckets):
    monkeypatch.setattr(dedup, "BUCKETS", buckets)
    monkeypatch.setattr(dedup, "PREFIX_CHARS", 3)
    chance = random.Random(12)
    rows = [(i, "".join(chance.choices("abAB ", k=chance.randint(0, 6)))) for i in range(400)]
    rows += [(i, "one text of a third of all rows") for i in range(400, 600)]
    check(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5), rows)


def test_kept_rows_have_all_their_columns(hard, nothing):
    kept = dedup.keep_last(hard)
    assert kept.schema.names == hard.columns
    rows = kept.collect()
    assert len(rows) == len({(t or "") for _, t in HARD})
    assert {r.doc_id for r in rows if r.text == "repeated row"} == {6}
    assert {r.label for r in rows} == {"kept"}
    assert dedup.keep_last(nothing).collect() == [] and dedup.classes(nothing).collect() == []


def test_main_path_has_no_python(spark):
    docs = spark.createDataFrame([(1, "x"), (2, "x"), (3, "yy")], "doc_id bigint, text string")
    plan = dedup.classes(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
