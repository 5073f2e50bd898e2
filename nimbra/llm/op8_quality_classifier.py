"""Quality classifier: supervised subword embeddings.

A document is the mean of the vectors of its features: its words, pairs of adjacent
words (a word with itself is one feature, whatever the word), and the character n-grams
of its words, all hashed into one table. A softmax over that mean gives the classes.
Vectors and output weights are learned by stochastic gradient descent in numpy. As the
output is linear in the mean, documents are scored with one number for each feature.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType

from nimbra.llm.common import fold_of, materialize, table, words_of
from nimbra.llm.hashing import mixed, word_hashes, word_ngrams

#: Bound of the labelled rows that the model is fitted on (expected count).
TRAIN_ROWS = 4000
BUCKETS = 1 << 16
DIMENSIONS = 8
NGRAMS = (3, 4)
EPOCHS = 12
BATCH = 32
RATE = 4.0
SEED = 8
#: A document counts as good from this score on.
THRESHOLD = 0.3

FOLDS = 5
_SAME = np.uint64(BUCKETS - 1)
#: Distinct words that a worker remembers.
KEPT_WORDS = 400_000


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes % np.uint64(BUCKETS - 1)).astype(np.int64)


def _pairs(hashes: np.ndarray) -> np.ndarray:
    """Buckets of adjacent words."""
    a, b = hashes[:-1], hashes[1:]
    return np.where(a == b, np.int64(_SAME), _bucket(mixed(a * np.uint64(31) + b)))


def document_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a text and the share of each among its features."""
    words = words_of(text)
    if not words:
        return np.empty(0, np.int64), np.empty(0)
    distinct = list(dict.fromkeys(words))
    place = {word: i for i, word in enumerate(distinct)}
    at = np.array([place[word] for word in words])
    hashes = word_hashes(distinct)
    grams, owner = word_ngrams(distinct, NGRAMS)
    times = np.bincount(at, minlength=len(distinct))
    counts = np.bincount(_bucket(hashes), weights=times, minlength=BUCKETS)
    counts += np.bincount(_bucket(grams), weights=times[owner], minlength=BUCKETS)
    counts += np.bincount(_pairs(hashes[at]), minlength=BUCKETS)
    found = np.flatnonzero(counts)
    return found, counts[found] / counts.sum()


class Model:
    """One number for each bucket, and a constant: the log odds of class 1 are their mean plus it."""

    def __init__(self, weights: np.ndarray, constant: float):
        self.weights, self.constant = weights.astype(np.float32), float(constant)
        self.index: dict[str, int] = {}
        self.hashes = np.empty(0, np.uint64)
        self.sums = np.empty(0)
        self.counts = np.empty(0)

    def _learn_words(self, texts: list[list[str]]) -> None:
        if len(self.index) > KEPT_WORDS:
            self.__init__(self.weights, self.constant)
        new = list({word for words in texts for word in words}.difference(self.index))
        if not new:
            return
        self.index.update(zip(new, range(len(self.index), len(self.index) + len(new)), strict=True))
        hashes = word_hashes(new)
        grams, owner = word_ngrams(new, NGRAMS)
        sums = np.bincount(owner, weights=self.weights[_bucket(grams)], minlength=len(new))
        self.hashes = np.concatenate([self.hashes, hashes])
        self.sums = np.concatenate([self.sums, sums + self.weights[_bucket(hashes)]])
        self.counts = np.concatenate([self.counts, np.bincount(owner, minlength=len(new)) + 1.0])

    def scores(self, texts: list[str]) -> np.ndarray:
        cut = [words_of(text) for text in texts]
        self._learn_words(cut)
        out = np.empty(len(texts))
        for i, words in enumerate(cut):
            total, features = 0.0, 1.0
            if words:
                at = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
                total = self.sums[at].sum() + self.weights[_pairs(self.hashes[at])].sum()
                features = self.counts[at].sum() + len(words) - 1
            out[i] = total / features + self.constant
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def train(features: list[np.ndarray], shares: list[np.ndarray], labels: np.ndarray, seed: int = SEED) -> Model:
    """Fit vectors and softmax on documents given as buckets and shares. Classes weigh
    alike in total; with one class alone, the constant says it."""
    draw = np.random.default_rng(seed)
    positive = labels.mean() if len(labels) else 0.5
    if not 0 < positive < 1:
        return Model(np.zeros(BUCKETS), 4.0 if positive == 1 else -4.0 if len(labels) else 0.0)
    vectors = draw.normal(0, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS))
    output, bias = draw.normal(0, 0.1, (DIMENSIONS, 2)), np.zeros(2)
    weight = np.where(labels == 1, 0.5 / positive, 0.5 / (1 - positive))
    steps = EPOCHS * -(-len(labels) // BATCH)
    step = 0
    for _ in range(EPOCHS):
        order = draw.permutation(len(labels))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            rate = RATE * (1 - step / steps)
            step += 1
            idx = np.concatenate([features[r] for r in rows])
            share = np.concatenate([shares[r] for r in rows])
            doc = np.repeat(np.arange(len(rows)), [len(features[r]) for r in rows])
            inputs = vectors[idx] * share[:, None]
            mean = np.stack([np.bincount(doc, weights=inputs[:, j], minlength=len(rows)) for j in range(DIMENSIONS)], axis=1)
            logits = mean @ output + bias
            logits -= logits.max(axis=1, keepdims=True)
            error = np.exp(logits)
            error /= error.sum(axis=1, keepdims=True)
            error[np.arange(len(rows)), labels[rows]] -= 1
            error *= weight[rows, None] / len(rows)
            back = error @ output.T
            output -= rate * mean.T @ error
            bias -= rate * error.sum(axis=0) * 0.1
            # a feature's gradient carries its share; shares are small, so its rate is larger
            for j in range(DIMENSIONS):
                np.subtract.at(vectors[:, j], idx, rate * 10 * share * back[doc, j])
    return Model(vectors @ (output[:, 1] - output[:, 0]), bias[1] - bias[0])


def fit(labelled: DataFrame, text_col: str, label_col: str, rows: int = TRAIN_ROWS) -> Model:
    """Fit on at most about ``rows`` of the labelled documents, drawn evenly by row; features
    are made on the executors. Rows with a null label are no examples."""
    labelled = labelled.where(F.col(label_col).isin(0, 1))
    held = materialize(labelled.select(F.col(text_col).alias("text"), F.col(label_col).cast("int").alias("label"), F.rand(SEED).alias("draw")), "quality-train")
    count = held.count()
    chosen = held.where(F.col("draw") < min(1.0, rows / max(1, count))) if count > rows else held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [document_features(text or "") for text in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1),
                    batch.column(2),
                    pa.array([f.astype(np.int32) for f, _ in made], pa.list_(pa.int32())),
                    pa.array([s.astype(np.float32) for _, s in made], pa.list_(pa.float32())),
                ],
                ["label", "draw", "features", "shares"],
            )

    got = chosen.select("text", "label", "draw").mapInArrow(run, "label int, draw double, features array<int>, shares array<float>").toArrow()
    order = np.argsort(got["draw"].to_numpy(), kind="stable")
    features = [got["features"][int(i)].values.to_numpy() for i in order]
    shares = [got["shares"][int(i)].values.to_numpy().astype(np.float64) for i in order]
    return train(features, shares, got["label"].to_numpy()[order].astype(np.int64))


def scores(model: Model, text: Column) -> Column:
    """Scores of a text column (null: empty): 0 to 1, higher where class 1 is likelier."""
    weights, constant = model.weights, model.constant

    @F.pandas_udf(DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Model(weights, constant)
        for texts in batches:
            values = [text or "" for text in texts]
            yield pd.Series(np.concatenate([np.empty(0), *(scorer.scores(values[i : i + 500]) for i in range(0, len(values), 500))]))

    return score(text)


def training_rows(docs: DataFrame, labels: DataFrame, label: str, rows: int, folds: int = FOLDS) -> DataFrame:
    """(text, label) of labelled documents outside the held-out fold, about ``rows`` of them at
    most, drawn by a hash of the id. Labels repeated for an id count once (the largest); a null
    id has no label. The drawn ids, bounded by ``rows``, go to every task; no text is shuffled."""
    wanted = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").alias("__id"))
        .agg(F.max(label).alias("label"))
        .where(fold_of("__id", folds) != 0)
    )
    share = min(1.0, rows / max(1, wanted.count()))
    drawn = wanted.where(F.pmod(F.xxhash64("__id", F.lit(SEED)), F.lit(1_000_000)) < int(share * 1_000_000))
    seen = docs.select(F.col("doc_id").alias("__id"), "text")
    return seen.join(F.broadcast(drawn), "__id").select("text", "label")


def fitted(spark: SparkSession, sf_dir: str) -> Model:
    """The model of the table of documents and its labels."""
    return fit(training_rows(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "quality", TRAIN_ROWS), "text", "label")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of at least the threshold's score. The model is learned from the labelled part of
    the table of documents: what earlier stages kept may hold no bad example any more."""
    return docs.where(scores(fitted(spark, sf_dir), F.col("text")) >= THRESHOLD)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fitted(spark, sf_dir)
    return docs.select(
        "doc_id", (fold_of("doc_id", FOLDS) == 0).alias("held_out"), scores(model, F.col("text")).alias("score")
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
