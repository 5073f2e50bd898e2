"""Ids of any type and size, patterns and long runs, step groups."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest

from nimbra.llm import op3_bpe, op4_token_files, op10_packing
from nimbra.llm.library_tokens import library_encoder

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("kind", ["bigint", "string", "double"])
def test_files_are_in_order_of_ids_of_any_type(spark, tmp_path, plain, kind):
    make = {"bigint": lambda i: 2**60 + i, "string": lambda i: f"é{i}", "double": float}[kind]
    ids = [make(i) for i in range(500)] + [make(7)] * 300 + [None, None]
    random.Random(4).shuffle(ids)
    rows = [(i, f"text {n} of many") for n, i in enumerate(ids)]
    docs = spark.createDataFrame(rows, f"id {kind}, text string").repartition(6)
    op4_token_files.write_token_files(docs, str(tmp_path / "files"), TOKENIZER, end_id=0, id_col="id")
    got = op4_token_files.read_token_files(spark, str(tmp_path / "files")).orderBy("start").collect()
    assert [r["id"] for r in got] == sorted(ids, key=lambda i: (i is not None, i or make(0)))
    at = 0
    for r in got:
        assert r["start"] == at
        at += len(r["ids"]) // 4
    texts = sorted(str([*plain(text), 0]) for _, text in rows)
    assert sorted(str(np.frombuffer(r["ids"], "<u4").tolist()) for r in got) == texts
    spread = spark.read.parquet(str(tmp_path / "files" / "blocks")).groupBy("part").sum("n_ids").count()
    assert spread > 2  # the id of a third of all rows does not make one part


def test_texts_of_lines_and_marks_are_the_librarys(plain):
    draw = random.Random(10)
    words = ["Über.", "a,", "b", "don't", "x.\nY,", "\n\nz", "12", "中文", "(k)", "é.\nÈ", "", "<|endoftext|>", "q.\n"]
    texts = [" ".join(draw.choices(words, k=draw.randint(0, 12))) for _ in range(2000)]
    encoder = library_encoder(TOKENIZER)
    for _ in range(2):  # learned, then remembered
        got = [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode(texts)]
        assert got == [plain(text) for text in texts]


def test_memory_of_chunks_is_bounded_by_characters(plain):
    encoder = library_encoder(TOKENIZER)
    encoder.encode(["k" * 5000 + " " + "m" * 5000])
    assert max(map(len, [*encoder.first, *encoder.later]), default=0) <= 64
    kept, encoder.kept_chars = encoder.kept_chars, 10
    try:
        texts = [f"word{i} other{i}" for i in range(50)]
        for text in texts:
            assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == plain(text)
        assert len(encoder.later) < 5
    finally:
        encoder.kept_chars = kept


def test_other_patterns_are_honoured():
    import tiktoken

    pattern = r"[A-Z]?[a-z]+|[^a-z]"
    codec = op3_bpe.codec(RANKS, pattern)
    library = tiktoken.Encoding("t", pat_str=pattern, mergeable_ranks=codec.ranks, special_tokens={})
    texts = ["The cat sat on Two mats", "a  b C dE 12 é", "", "don't stop"]
    assert [ids.tolist() for ids in codec.encode(texts)] == [library.encode_ordinary(t) for t in texts]


def test_long_runs_are_merged_like_short_ones():
    import tiktoken

    codec = op3_bpe.codec(RANKS, public_tokenizers.PATTERN)
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    draw = random.Random(3)
    texts = ["y" * 100_000, "ab" * 3000, "中文字符" * 5000, "".join(draw.choices("etaoinshr", k=200_000))]
    assert [ids.tolist() for ids in codec.encode(texts)] == [library.encode_ordinary(t) for t in texts]
    for size in (2, 50, 700):  # both forms on the same pieces
        pieces = ["".join(draw.choices("etaoinshré", k=size)).encode() for _ in range(50)]
        assert [codec._merge_linked(p) for p in pieces] == [codec.encode_pieces([p])[0] for p in pieces]


def test_only_the_last_step_group_of_a_context_is_short():
    draw = random.Random(10)
    packer = op10_packing.TierPacker(op10_packing.CONTEXTS)
    step, sizes = 1 << 14, []
    for flush in range(6):
        for key in range(200):
            packer.add(key, bytes(4 * draw.randint(1, 3000)))
        packer.pack(last=flush == 5)
        windows = packer.windows if flush == 5 else packer.whole_groups(step)
        groups = op10_packing.step_groups(windows, step)
        tokens = {}
        for (context, _), group in zip(windows, groups, strict=True):
            tokens.setdefault((context, group), 0)
            tokens[context, group] += context
        sizes.append(tokens)
    assert all(n == step for tokens in sizes[:-1] for n in tokens.values()) and sizes[0]
