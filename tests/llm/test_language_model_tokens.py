"""Tokens of the language model are cut by Arrow as by plain Python, and its sums do not depend on the cut of the texts."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from nimbra.llm import op5_language_model as lm
from nimbra.llm.common import lower, words_of
from nimbra.llm.hashing import array_hashes, word_hashes


def test_tokens_are_those_of_plain_python():
    draw = random.Random(5)
    letters = " \n\t\r\x0b\x0c\x1c\x85\xa0　abAB'sS.,;ve!?19é中🙂ÀÄß\x00“”…"
    texts = ["".join(draw.choices(letters, k=draw.randint(0, 40))) for _ in range(2000)] + ["", None, " \n"]
    for type_ in (pa.string(), pa.large_string()):
        for begin, end in ((0, 2003), (700, 1500), (1999, 2003), (5, 5)):  # slices, as of a batch
            known = lm.Tokens(pa.array(texts, type_)[begin:end])
            words = known.words.to_pylist()
            cut = [[*words_of(lower(text or "")), lm.END] for text in texts[begin:end]]
            assert [words[i] for i in known.at] == [word for part in cut for word in part]
            assert known.starts.tolist() == np.cumsum([0, *map(len, cut)])[:-1].tolist()
            assert (known.hashes == word_hashes(words)).all() and (array_hashes(known.words[1:]) == known.hashes[1:]).all()


def test_sums_do_not_depend_on_the_cut_of_texts(spark):
    rows = [(f"aa bbing {i % 7} cc" if i % 2 else f"cc kking {i % 5}",) for i in range(3000)]
    docs = spark.createDataFrame(rows, "text string")
    weights = []
    for parts in (1, 3):
        model = lm.Model({}, np.arange(lm.FORMS) % lm.CLASSES, 0, 1000)
        totals = np.ones((32 * 32, 32))
        totals[:, 4:] = 0
        totals[::3, 0] = 500
        model.set_ranked(totals.ravel())
        lm._round(model, docs.repartition(parts))
        weights.append(model.weights)
    assert np.abs(weights[0][lm.BUCKETS * lm.CLASSES :]).max() > 0
    assert np.allclose(*weights, atol=1e-4)
