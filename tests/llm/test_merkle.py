from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from nimbra.llm import op11_merkle as merkle

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, leaf string, `group` string"


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(row, n_chars) -> str:
    doc_id, text, lang, source, *_ = row
    return h(*[field(x) for x in (doc_id, source, lang, n_chars, text)])


def climbed(nodes: list[str]) -> tuple[str, list[list[tuple[bool, str | None]]]]:
    """The top, and for every node the steps (sibling on the left, sibling) up to it."""
    paths: list[list] = [[] for _ in nodes]
    under = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        for i in range(len(nodes)):
            other = nodes[i ^ 1] if i ^ 1 < len(nodes) else None
            for leaf in under[i]:
                paths[leaf].append((bool(i & 1), other))
        under = [sum(under[i : i + 2], []) for i in range(0, len(nodes), 2)]
        nodes = [h(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
    return nodes[0], paths


def expected(rows) -> list[tuple]:
    groups: dict = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    subroots, members = [], []
    for lang in sorted(groups, key=lambda x: (x is not None, (x or "").encode())):
        found = [(r[0] is not None, r[0], leaf_of(r, r[4]), r) for r in groups[lang]]
        ordered = sorted(found, key=lambda x: (x[0], x[1] or 0, x[2]))
        subroot, paths = climbed([x[2] for x in ordered])
        subroots.append(subroot)
        members.append([(x[3], x[2], path) for x, path in zip(ordered, paths, strict=True)])
    root, above = climbed(subroots)
    out = []
    for subroot, path_above, group in zip(subroots, above, members, strict=True):
        for row, leaf, path in group:
            steps = path + path_above
            n_chars = row[4]
            if n_chars is not None and zlib.crc32(str(row[0] if row[0] is not None else "").encode()) % 7 == 0:
                n_chars += 1
            node = leaf_of(row, n_chars)
            for left, other in steps:
                node = h(node) if other is None else h(other, node) if left else h(node, other)
            proof = h(*[other for _, other in steps if other])
            out.append((row[0], leaf, subroot, root, proof, node, node == root))
    return out


def got(spark, monkeypatch, rows) -> list[tuple]:
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    monkeypatch.setattr(merkle, "table", lambda *_: docs)
    return [tuple(row) for row in merkle.query(spark, "").collect()]


def order(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("levels, digits", [(4, 3), (1, 2), (2, 1)])
def test_query_equals_plain_python(spark, monkeypatch, levels, digits):
    """Small blocks take several rounds: the tree must not show where blocks end."""
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "DIGITS", digits)
    monkeypatch.setattr(merkle, "_BLOCK", levels * digits)
    chance = random.Random(11)
    rows = [(i, f"text {i} ä", "en", "web", i, "x", "y") for i in chance.sample(range(-50, 900), 75)]
    rows += [(i, "hola", "es", None, None, "x", None) for i in range(17)]
    rows += [(5, "", "é", "a", 1, None, None), (6, None, None, "b", 2, None, "z"), (None, "t", "en", "c", 3, "x", "y")]
    rows += [(7, "twice", "de", "a", 2**63 - 1, "", "")] * 2 + [(7, "other", "de", "a", 5, "", "")]
    rows += [(i, "x", f"lang {i}", "s", 1, "", "") for i in range(20)]
    assert order(got(spark, monkeypatch, rows)) == order(expected(rows))


def test_single_row_and_empty_table(spark, monkeypatch):
    row = (14, "long " * 100_000, "en", "web", 500_000, "", "")
    assert got(spark, monkeypatch, [row]) == expected([row])
    docs = spark.createDataFrame([], SCHEMA)
    monkeypatch.setattr(merkle, "table", lambda *_: docs)
    assert merkle.query(spark, "").collect() == []


def test_a_changed_leaf_does_not_lead_to_the_root(spark):
    docs = spark.createDataFrame([(i, f"t{i}", "a" if i % 3 else None) for i in range(40)], "id int, text string, kind string")
    proofs = merkle.manifest(docs, "id", "kind", [F.col("id"), F.col("text")], {"was": F.col("text")})
    assert set(proofs.columns) == {"id", "kind", "was", "leaf", "path", "subroot", "root"}
    ok = merkle.folded(F.col("leaf"), F.col("path")) == F.col("root")
    forged = merkle.folded(merkle.digest(F.col("leaf")), F.col("path")) == F.col("root")
    assert proofs.where(ok).count() == 40 and proofs.where(forged).count() == 0


def test_leaves_are_not_joined(spark):
    docs = spark.createDataFrame([(i, "t", "a") for i in range(40)], "id int, text string, kind string")
    plan = merkle.manifest(docs, "id", "kind", [F.col("text")])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
