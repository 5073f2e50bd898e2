"""The language model tells words of one class and count apart by what stands before them."""

from __future__ import annotations

import zlib

import numpy as np

from nimbra.llm import op5_language_model


def _held(i):
    return zlib.crc32(str(i).encode()) % 7 == 2


def test_word_order_counts_among_words_of_one_form(spark):
    rows = spark.range(200_000).selectExpr("id AS doc_id", "IF(id % 2 = 0, 'aa bbing', 'cc kking') AS text")
    probes = [i for i in range(1_000_000, 1_001_000) if _held(i)][:4]
    texts = ["aa bbing", "cc kking", "aa kking", "cc bbing"]
    docs = rows.unionByName(spark.createDataFrame(list(zip(probes, texts)), "doc_id bigint, text string"))
    got = {r["doc_id"]: r["score"] for r in op5_language_model.score(docs).where("doc_id >= 1000000").collect()}
    seen, shuffled = got[probes[0]] + got[probes[1]], got[probes[2]] + got[probes[3]]
    assert seen > shuffled + 1


def test_word_buckets_are_a_distribution():
    draw = np.random.default_rng(0)
    model = op5_language_model.Model({}, np.zeros(op5_language_model.FORMS, np.int64), 0, 1000)
    assert model.bits == 7
    totals = np.ones((32 * 32, 32))
    totals[:, 4:] = 0
    model.set_totals(totals.ravel() * draw.integers(1, 9, totals.size))
    model.weights[:] = draw.normal(size=model.weights.shape)
    hashes, starts = draw.integers(0, 2**63, 3).astype(np.uint64), np.array([0, 2])
    total = np.zeros(3)
    for of in range(32):
        for a in range(32):
            for b in range(4):
                one = [np.full(3, v) for v in (of, a, b)]
                total += np.exp(model.log_probabilities(hashes, starts, one[0], one[1:]))
    assert np.allclose(total, 1, atol=1e-3)
