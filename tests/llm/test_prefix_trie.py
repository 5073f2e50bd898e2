from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from nimbra.llm import op13_prefix_trie as trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, node string, part int, depth string"


def digest(role, text) -> bytes:
    role, text = role or "", text or ""
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]


def conversations(rows) -> dict[int, list[tuple[str, str]]]:
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, digest(role, text), role or "", text or ""))
    turns = {conv: [t[3:] for t in sorted(found)] for conv, found in own.items()}
    out = {}
    for conv in turns:
        h = zlib.crc32(str(conv).encode()) % 4
        first = conv - (conv % 20 if conv >= 0 else -(-conv % 20))
        out[conv] = turns.get(first, [])[:h] + turns[conv][h:]
    return out


def expected(rows) -> list[tuple]:
    members, ends = defaultdict(list), defaultdict(list)
    for conv, turns in conversations(rows).items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
        ends[tuple(turns)].append(conv)
    children = defaultdict(list)
    for key in members:
        if key:
            children[key[:-1]].append(key)

    def own(key):
        return (len(members[key]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", key[-1][1])) if key else 0

    leaves, saved = {}, {}
    for key in sorted(members, key=len, reverse=True):
        leaves[key] = sum(leaves[c] for c in children[key]) or 1
        saved[key] = own(key) + sum(saved[c] for c in children[key])
    return [
        (
            min(members[key]), len(key), min(members[key[:-1]]) if key else None, len(members[key]),
            len(children[key]), leaves[key], saved[key],
            hashlib.sha256(",".join(map(str, sorted(ends.get(key, [])))).encode()).hexdigest(),
        )
        for key in members
    ]


def check(spark, rows, **options):
    frame = spark.createDataFrame([(*row, "x", 1, "y") for row in rows], SCHEMA).repartition(3)
    found = trie.trie(trie.rebuilt(frame), **options).drop("node").collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected(rows)))


@pytest.mark.parametrize("turns_of_block", [2, 9, 100_000])
def test_nodes_over_many_blocks(spark, turns_of_block):
    """Few different turns, so subtrees, ends and leaves go over the edges of blocks."""
    chance = random.Random(13)
    rows = []
    for conv in range(120):
        for turn in range(chance.choice([1, 1, 2, 3, 5])):
            rows.append((conv, turn, "user", chance.choice(["a", "b b", "c c c"])))
    check(spark, rows, turns_of_block=turns_of_block)


def test_a_third_of_all_conversations_are_one(spark):
    rows = [(conv, turn, "user", f"t{turn}") for conv in range(0, 2000, 20) for turn in range(3)]
    rows += [(conv, 0, "user", f"own {conv}") for conv in range(100)]
    check(spark, rows, turns_of_block=7)


def test_hard_rows(spark):
    long_text = "word " * 200_000
    rows = [
        (None, 0, "user", "nobody"), (-3, 1, "user", "minus"), (-3, 0, None, None), (0, None, "", ""),
        (0, 0, "user", long_text), (0, 0, "user", long_text), (5, 2, "user", "tie"), (5, 2, "bot", "tie"),
        (7, 0, "only", "replaced"), (20, 1, "a", "bc"), (40, 1, "ab", "c"), (2**53 + 20, 0, "a", "bc"),
    ]
    rows += [(60, turn, "user", f"step {turn}") for turn in range(700)]
    check(spark, rows, turns_of_block=50)


def test_conversations_without_turns_end_at_the_root(spark):
    lone = [c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 >= 1]
    check(spark, [(c, 0, "user", "gone") for c in lone])


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert trie.trie(trie.rebuilt(empty)).collect() == []


def test_reach_equals_a_walk():
    chance = np.random.default_rng(13)
    values = chance.integers(0, 6, 200)
    minima = trie.RangeMinimum(values)
    at, least = chance.integers(0, 200, 500), chance.integers(0, 7, 500)
    for i, d, r, left in zip(at, least, minima.reach_right(at, least), minima.reach_left(at, least), strict=True):
        right = i
        while right + 1 < 200 and values[right + 1] >= d:
            right += 1
        first = i
        while first > 0 and values[first] >= d:
            first -= 1
        assert (r, left) == (right, first)
