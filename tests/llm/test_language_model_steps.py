"""A word is told by bits, of which only those that are met on both sides have weights; rounds add blocks up."""

from __future__ import annotations

import numpy as np

from nimbra.llm import op5_language_model as lm


def _model() -> lm.Model:
    model = lm.Model({}, np.zeros(lm.FORMS, np.int64), 0, 1000)
    totals = np.ones((32 * 32, 32))
    totals[:, 4:] = 0
    totals[:16, 0] = 500
    model.set_totals(totals.ravel())
    return model


def test_bits_without_choice_take_no_weights():
    model = _model()
    at, nodes, bits = model.steps(np.array([0, 1024]))
    assert 3 <= (at == 0).sum() <= 5 and set(nodes[at == 0]) >= {32 + 0}
    assert not bits[at == 0].any()


def test_a_trained_word_is_likelier_after_its_context():
    model, draw = _model(), np.random.default_rng(2)
    before = draw.integers(0, 2, 4000)
    hashes = np.stack([np.array([11, 99], np.uint64)[before], np.full(4000, 7, np.uint64)], 1).ravel()
    starts = np.arange(0, 8000, 2)
    buckets = np.zeros(8000, np.int64)
    buckets[1::2] = before * 32 * 8  # the word follows from the token before it
    trainer = lm.Trainer(model)
    trainer.learn(lm.contexts(hashes, starts), np.zeros(8000, np.int64), buckets)
    digits = [buckets // 32, buckets % 32]
    untrained = model.log_probabilities(hashes, starts, np.zeros(8000, np.int64), digits)[1::2]
    model.weights = trainer.weights
    trained = model.log_probabilities(hashes, starts, np.zeros(8000, np.int64), digits)[1::2]
    assert trained.mean() > untrained.mean() + 0.5


def test_a_round_takes_the_mean_of_all_tasks(spark):
    docs = spark.range(4000).selectExpr("IF(id % 2 = 0, 'aa bbing', 'cc kking') AS text").repartition(4)
    model = _model()
    lm._round(model, docs)
    assert np.isfinite(model.weights).all() and (model.squares >= 0).all()
    assert np.abs(lm.parts_of(model.weights)[0]).max() < 50 and model.squares[: lm.BUCKETS].max() > 0
