"""Operators on texts, against plain implementations on hard rows."""

from __future__ import annotations

import base64
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from nimbra.llm import (
    op1_toxicity,
    op2_simhash,
    op3_bpe,
    op4_token_files,
    op5_language_model,
    op6_quality_rules,
    op8_quality_classifier,
    op10_packing,
)
from tests.llm.conftest import HARD

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def words_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split("[\x20\x09-\x0d]+", lowered) if w]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_bpe_is_the_librarys(spark, hard, nothing):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    plain = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = op3_bpe.decode(op3_bpe.encode(hard, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN)
    expected = Counter((i, tuple(plain.encode_ordinary(t or "")), (t or "").encode()) for i, t in HARD)
    assert Counter((r["id"], tuple(r["ids"]), bytes(r["bytes"])) for r in got.collect()) == expected
    assert op3_bpe.encode(nothing, RANKS, public_tokenizers.PATTERN).count() == 0


def test_bpe_of_mixed_white_space(spark):
    import random
    import tiktoken

    draw, letters = random.Random(3), " \n\t\r\x0b\x1c\x85\xa0　ab'sS ve!?19é中🙂̈"
    texts = ["".join(draw.choice(letters) for _ in range(draw.randint(0, 30))) for _ in range(3000)]
    codec = op3_bpe.codec(RANKS, public_tokenizers.PATTERN)
    plain = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    assert [ids.tolist() for ids in codec.encode(texts)] == [plain.encode_ordinary(t) for t in texts]


@pytest.mark.parametrize("width", [1, 5, 8, 13, 16, 17, 24, 31, 32])
def test_bits_round_trip(width):
    ids = np.random.default_rng(0).integers(0, 2**width, 999).astype("<u4")
    packed = op4_token_files.pack_bits(ids, width)
    assert len(packed) == -(-999 * width // 8)
    assert (op4_token_files.unpack_bits(packed, width, 0, 999) == ids).all()
    assert (op4_token_files.unpack_bits(packed, width, 101, 702) == ids[101:702]).all()


def test_token_files(spark, hard, nothing, tmp_path, library):
    op4_token_files.write_token_files(hard, str(tmp_path / "a"), TOKENIZER, end_id=0)
    got = op4_token_files.read_token_files(spark, str(tmp_path / "a")).orderBy("start").collect()
    ordered = sorted(HARD, key=lambda row: (row[0] is not None, row[0] or 0))
    assert [r["id"] for r in got] == [i for i, _ in ordered]
    flat, texts = [], {i: t for i, t in HARD}
    for r in got:
        ids = [*library(texts[r["id"]]), 0]
        assert r["start"] == len(flat) and np.frombuffer(r["ids"], "<u4").tolist() == ids
        flat += ids
    part = op4_token_files.read_range(spark, str(tmp_path / "a"), 5, len(flat) - 9).orderBy("start").collect()
    assert b"".join(bytes(r["ids"]) for r in part) == np.array(flat[5:-4], "<u4").tobytes()
    op4_token_files.write_token_files(nothing, str(tmp_path / "b"), TOKENIZER, end_id=0)
    assert op4_token_files.read_token_files(spark, str(tmp_path / "b")).count() == 0


def test_packing(spark, hard, nothing, library):
    got = op10_packing.pack(hard, TOKENIZER, 1).collect()
    by_document: dict = {}
    for r in got:
        by_document.setdefault(r["doc_id"], []).append(r)
    texts = {i: t for i, t in HARD}
    for i, pieces in by_document.items():
        ids, times = [*library(texts[i]), 1], sum(j == i for j, _ in HARD)
        seen = Counter()
        for p in pieces:
            assert np.frombuffer(p["ids"], "<u4").tolist() == ids[p["start"] : p["start"] + p["length"]]
            assert p["doc_tokens"] == len(ids)
            seen.update(range(p["start"], p["start"] + p["length"]))
        assert seen == Counter({k: times for k in range(len(ids))})
    for pieces in (sorted(g, key=lambda r: r["offset"]) for g in _groups(got, "sequence_id")):
        ends = np.cumsum([p["length"] for p in pieces])
        assert [p["offset"] for p in pieces] == [0, *ends[:-1]]
        assert ends[-1] <= 2048 and ends[-1] & (ends[-1] - 1) == 0  # a power of two: nothing is padded
    assert op10_packing.pack(nothing, TOKENIZER, 1).count() == 0


def _groups(rows, key):
    out: dict = {}
    for r in rows:
        out.setdefault(r[key], []).append(r)
    return out.values()


def test_step_groups_are_of_equal_size():
    windows = [(2048, [(0, 0, b"1234" * 2048, 2048)])] * 100 + [(512, [(0, 0, b"1234" * 512, 512)])] * 64
    groups = Counter(op10_packing.step_groups(windows, 1 << 16))
    assert sorted(groups.values()) == [25, 25, 25, 25, 64]


def fingerprint(text):
    words = words_of(text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(spark, hard, nothing):
    got = Counter((r["doc_id"], r["fp"] % 2**64, r["component"]) for r in op2_simhash.near_duplicates(hard).collect())
    prints = {t: fingerprint(t) for _, t in HARD}
    least: dict = {}
    for i, t in HARD:  # all fingerprints here are equal or far apart
        if i is not None:
            least[prints[t]] = min(i, least.get(prints[t], i))
    assert got == Counter((i, prints[t], least.get(prints[t])) for i, t in HARD)
    assert op2_simhash.near_duplicates(nothing).count() == 0
    kept = op2_simhash.keep_first(hard)
    assert kept.columns == hard.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 2, 5, 6]


@pytest.mark.parametrize("cell", [0, 256])
@pytest.mark.parametrize("max_bits", [0, 1, 2])
def test_links_by_brute_force(spark, monkeypatch, cell, max_bits):
    """Chains and crowds of near fingerprints; with ``cell`` 0 all go the way of crowded cells."""
    monkeypatch.setattr(op2_simhash, "CELL", cell)
    draw = np.random.default_rng(max_bits)
    prints = set(draw.integers(0, 2**63, 60).tolist())
    for start in list(prints)[:6]:
        for _ in range(25):
            start ^= (1 << int(draw.integers(0, 63))) | (1 << int(draw.integers(0, 63)))
            prints.add(start)
    rows = spark.createDataFrame([(k, int(p)) for k, p in enumerate(sorted(prints))], "key bigint, fp bigint")
    got = {r["key"]: r["component"] for r in op2_simhash.components(rows, max_bits).collect()}
    ordered, of = sorted(prints), list(range(len(prints)))
    for a, x in enumerate(ordered):
        for b in range(a):
            if bin(x ^ ordered[b]).count("1") <= max_bits and of[a] != of[b]:
                old, new = max(of[a], of[b]), min(of[a], of[b])
                of = [new if c == old else c for c in of]
    assert got == dict(enumerate(of))


def test_quality_rules_equal_sql(spark, hard, nothing):
    got = op6_quality_rules.measures(hard)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", HARD)
    answer = con.execute(op6_quality_rules.ORACLE)
    names = [d[0] for d in answer.description]
    assert Counter(tuple(r[n] for n in names) for r in got.collect()) == Counter(answer.fetchall())
    assert op6_quality_rules.measures(nothing).count() == 0
    assert op6_quality_rules.filter_documents(nothing).count() == 0
    kept = op6_quality_rules.filter_documents(hard)
    assert kept.columns == hard.columns and kept.count() == got.where("kept").count()


def test_rules_leave_columns_of_any_name_alone(spark):
    text = " ".join(f"unlike{i}" for i in range(80))
    docs = spark.createDataFrame([(1, text, "mine", [1])], "doc_id int, text string, __text string, __words array<int>")
    assert op6_quality_rules.filter_documents(docs).collect() == docs.collect()


def test_the_order_of_rules_changes_no_verdict(spark):
    text = "one two three four five six seven eight nine ten " * 3 + "unlike words follow here " + " ".join(map(str, range(60)))
    docs = op6_quality_rules.with_words(spark.createDataFrame([(1, text), (2, text.upper()), (3, "#| " * 90)], "doc_id int, text string"))
    rules = op6_quality_rules.base_rules() | op6_quality_rules.more_rules()
    for order in (sorted(rules), sorted(rules, reverse=True)):
        got = docs.select("doc_id", op6_quality_rules.kept(rules, order).alias("kept")).collect()
        assert {r["doc_id"]: r["kept"] for r in got} == {1: True, 2: False, 3: False}


def test_quality_rules_are_native(spark, hard):
    plan = op6_quality_rules.measures(hard)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_language_model_counts(spark, hard, nothing, monkeypatch):
    """Whatever part of the words the tasks know, counts and base scores are those of a plain count."""
    tokens = [(i, [*words_of(t), " "]) for i, t in HARD]
    held = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 7 == 2
    counts = Counter(w for i, ws in tokens if not held(i) for w in ws)
    n, v = sum(counts.values()), len(counts)
    expected = Counter()
    for i, ws in tokens:
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws)
        expected[i, held(i), len(ws), sum(counts[w] > 0 for w in ws), n, f"{base:.6g}"] += 1
    for head in (2, 1 << 17):
        monkeypatch.setattr(op5_language_model, "HEAD", head)
        got = op5_language_model.score(hard)
        names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score"]
        found = Counter((*(r[c] for c in names[:-1]), f"{r['base_score']:.6g}") for r in got.collect())
        assert found == expected
        assert got.where("score > 0 OR score IS NULL").count() == 0
    assert op5_language_model.score(nothing).count() == 0


def test_language_model_is_a_distribution():
    draw = np.random.default_rng(0)
    weights = draw.normal(size=(op5_language_model.BUCKETS, op5_language_model.CLASSES)).astype(np.float32)
    at = op5_language_model.features(draw.integers(0, 2**63, 50).astype(np.uint64), np.array([0, 20]))
    assert np.allclose(np.exp(op5_language_model.class_log_probabilities(weights, at)).sum(axis=1), 1, atol=1e-5)


def _labelled(spark, bad, n=160):
    draw = np.random.default_rng(1)
    words = ["therein", "onward", "edited", "thistle", "another", "reason", "whether", "ending"]
    rows = []
    for i in range(n):
        text = [str(w) for w in draw.choice(words, 40)]
        rows.append((i, " ".join(bad(text, draw) if i % 4 == 0 else text), int(i % 4 != 0)))
    return spark.createDataFrame(rows, "doc_id bigint, text string, label int")


def test_quality_classifier_learns(spark, hard, nothing):
    rows = _labelled(spark, lambda text, draw: [w.upper() + "!!" for w in text])
    model = op8_quality_classifier.fit(rows.where("doc_id % 5 <> 0"), "text", "label")
    scored = rows.where("doc_id % 5 = 0").select("label", op8_quality_classifier.scores(model, F.col("text")).alias("s")).collect()
    assert all((r["s"] >= 0.5) == bool(r["label"]) for r in scored)
    assert hard.select(op8_quality_classifier.scores(model, F.col("text")).alias("s")).where("s BETWEEN 0 AND 1").count() == len(HARD)
    unfitted = op8_quality_classifier.fit(nothing.select("text", F.lit(1).alias("label")), "text", "label")
    assert nothing.select(op8_quality_classifier.scores(unfitted, F.col("text"))).count() == 0


def test_a_documents_score_is_that_of_its_features():
    draw = np.random.default_rng(2)
    model = op8_quality_classifier.Model(draw.normal(size=op8_quality_classifier.BUCKETS), 0.25)
    text = "The cat sat sat on the Mat, ä 中文!"
    buckets, shares = op8_quality_classifier.document_features(text)
    expected = 1 / (1 + math.exp(-((model.weights[buckets] * shares).sum() + 0.25)))
    assert abs(model.scores([text, ""])[0] - expected) < 1e-6


def test_toxicity_learns_terms_and_misspellings(spark, hard, nothing):
    def insult(text, draw):
        text[int(draw.integers(5, 30))] = ["blockhead", "nitwit"][int(draw.integers(0, 2))]
        return text

    rows = _labelled(spark, insult, 400).select("text", (1 - F.col("label")).alias("label"))
    model = op1_toxicity.fit(rows)
    assert {"blockhead", "nitwit"} <= set(model.weights)
    scanner = model.scanner()
    plain, misspelt, quoted = (
        scanner.features(t) for t in ("you are a blockhead ok", "you are a blokchead ok", 'the word "blockhead" was said')
    )
    clean = scanner.features("therein onward edited thistle")
    assert model.score(plain) > 0.5 > model.score(clean)
    assert model.score(misspelt) >= model.score(clean) and misspelt[1] + misspelt[2] > 0
    assert quoted[0] == 0 and quoted[3] > 0
    scored = hard.select(op1_toxicity.scores(model, F.col("text")).alias("s"), op1_toxicity.spans(model, F.col("text")).alias("h"))
    assert scored.where("s BETWEEN 0 AND 1 AND size(h) = 0").count() == len(HARD)
    unfitted = op1_toxicity.fit(nothing.select("text", F.lit(0).alias("label")))
    assert hard.select(op1_toxicity.scores(unfitted, F.col("text")).alias("s")).where("s < 0.5").count() == len(HARD)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def test_automaton_and_trie_by_brute_force():
    draw = np.random.default_rng(4)
    make = lambda n: "".join(draw.choice(list("abcd"), n))
    terms = {make(int(draw.integers(4, 12))): float(draw.random()) for _ in range(60)}
    lexicon = op1_toxicity.Lexicon(terms)
    for _ in range(400):
        word = make(int(draw.integers(4, 13)))
        near = [(distance(word, t), -w, t) for t, w in terms.items()]
        reach = 2 if len(word) >= 7 else 1
        near = [x for x in near if x[0] <= min(reach, op1_toxicity.allowed_edits(x[2]))]
        expected = (min(near)[2], min(near)[0]) if near else None
        assert lexicon.match(word) == expected


def test_hashes_do_not_depend_on_the_other_words():
    from nimbra.llm.hashing import word_hashes

    words = ["a", "b", "ab", "ba", "", "ä", "word " * 50, "\x00", "\x00\x00"]
    alone = [int(word_hashes([word])[0]) for word in words]
    assert word_hashes(["x" * 500, *words])[1:].tolist() == alone and len(set(alone)) == len(words)
