"""Language-model scores by a hashed maximum-entropy model with class-factored softmax.

A token's probability is that of its class given the tokens before it, times that of its
word bucket given class and tokens before, times its share in the bucket. Classes are learned: words fall into forms (short words as they are,
others by their endings), forms are described by their neighbours over the whole
training text, and similar forms make a class. The class is a softmax over hashed
features: the token before, the two before as a pair, and skips to the second and
third. A word's bucket is a row of bits, hashed from the word; each bit is a softmax of two
over the same features, joined with the class and the bits before it, and starts from
the count shares of the bits. Where either bit is met too rarely to learn from, its count
share stands. There are at least four buckets for a distinct word (up to 2^20 in all), so
most words have one of their own. All weights are trained by one step over the whole training
text, from the count shares: tasks add up what their documents give, and the sums of all tasks
are exact whatever the tasks. A class weight takes a part of the step of iterative scaling, from
the counts of its feature and class. A word weight takes a part of Newton's step, from its sums
of gradient and curvature; overlapping features share what a full step would give to each.

A token's share is (c + 1) / (sum of c + 1 over the bucket, + 1 for unknown words), c
its count in the training text. Counts are a table, joined to the tokens of rarer
words by a shuffle; the most frequent words (a fixed number) go to every task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from copy import copy

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from nimbra.llm.common import fold_of, materialize, slices, table
from nimbra.llm.hashing import array_hashes, mixed

#: The end of a text; no word holds a space.
END = " "
HELD_OUT_FOLDS, HELD_OUT_FOLD = 7, 2
#: Most frequent words known to every task.
HEAD = 1 << 17
FORMS, NEIGHBOURS = 2048, 256
CLASSES = 32
BUCKETS = 1 << 15
#: Weights of words, by feature, class and bits before; bits of word buckets in a class.
WORD_BITS = 22
LEAST_BITS, MOST_BITS = 5, 15
BATCH = 1024
#: Parts of a step that are taken, and what a weight must meet before it moves: tokens of the
#: shares at the start, and curvature. A word weight moves by WORD_MOST at most.
STEP, PRIOR = 0.6, 50.0
WORD_STEP, WORD_PRIOR, WORD_MOST = 0.5, 3.0, 2.0
#: A bit has weights where the rarer value has this share, and this count, at least.
LEAST_SHARE, LEAST_COUNT = 0.1, 200
#: Weights that are sent and added up together.
BLOCK = 4096
SEED = 5
#: Levels of a tree of bits whose weights, of one feature, lie together.
LEVELS = 3

_START = np.uint64(0x9E3779B97F4A7C15)
_SPREAD = np.uint32(0x86659FD9)
_EDGES = ".,;:!?…\"'()[]{}«»“”„|*#$%&"


def _forms(words: pa.Array) -> np.ndarray:
    core = pc.utf8_trim(words, characters=_EDGES)
    marked = pc.is_in(pc.utf8_slice_codeunits(words, -1), value_set=pa.array(list(_EDGES), words.type))
    before = pc.if_else(marked, pa.scalar(",", words.type), pa.scalar("-", words.type))
    ending = pc.binary_join_element_wise(before, pc.utf8_slice_codeunits(core, -3), pa.scalar("", words.type))
    forms = pc.if_else(pc.less_equal(pc.utf8_length(core), 4), words, ending)
    return (array_hashes(forms) % np.uint64(FORMS)).astype(np.int64)


class Tokens:
    """The tokens of texts, an end after each text, as numbers ``at`` of the distinct ``words``, and
    where each text starts; Arrow lowers, splits and numbers them."""

    def __init__(self, texts: pa.Array):
        # a copy: Arrow does not lower a cast slice of an array right
        texts = pc.fill_null(texts.take(pa.array(np.arange(len(texts)))).cast(pa.large_string()), "")
        cut = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        ends, flat = cut.offsets.to_numpy(), cut.values
        ends, flat = ends - ends[0], flat.slice(ends[0], ends[-1] - ends[0])
        real = pc.greater(pc.binary_length(flat), 0)  # what stands before white space at a text's start is empty
        ends = np.concatenate(([0], np.cumsum(real.to_numpy(zero_copy_only=False))))[ends]
        found = flat.filter(real).dictionary_encode()
        self.starts = ends[:-1] + np.arange(len(texts))
        self.at = np.full(ends[-1] + len(texts), len(found.dictionary), np.int64)
        inside = np.ones(len(self.at), bool)
        inside[ends[1:] + np.arange(len(texts))] = False
        self.at[inside] = found.indices.to_numpy()
        self.words = pa.concat_arrays([found.dictionary, pa.array([END], pa.large_string())])
        self.hashes, self.forms = array_hashes(self.words), _forms(self.words)


def _before(values: np.ndarray, place: np.ndarray, back: int, missing) -> np.ndarray:
    out = np.empty_like(values)
    out[:back] = missing
    out[back:] = values[:-back] if len(values) > back else values[:0]
    out[place < back] = missing
    return out


def contexts(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hashes of the features of every token, one row each."""
    lengths = np.diff(np.concatenate((starts, [len(hashes)])))
    place = np.arange(len(hashes)) - np.repeat(starts, lengths)
    one, two, three = (_before(hashes, place, back, _START) for back in (1, 2, 3))
    kinds = [one * np.uint64(3), one * np.uint64(5) + two, two * np.uint64(7), three * np.uint64(11)]
    return np.stack([mixed(kind + np.uint64(k)) for k, kind in enumerate(kinds)], axis=1)


def word_contexts(found: np.ndarray) -> np.ndarray:
    """What the features of words are told by, a row for each kind."""
    return np.ascontiguousarray((found >> np.uint64(32)).astype(np.uint32).T)


def class_features(found: np.ndarray) -> np.ndarray:
    """The buckets of the features of every token; the last bucket is constant."""
    buckets = (found % np.uint64(BUCKETS - 1)).astype(np.int64)
    return np.column_stack([buckets, np.full(len(found), BUCKETS - 1)])


def features(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return class_features(contexts(hashes, starts))


def bucket_bits(distinct: int) -> int:
    """Bits of the word buckets of a class: four buckets or more for a distinct word."""
    return min(MOST_BITS, max(LEAST_BITS, 2 + math.ceil(math.log2(max(1, distinct) / CLASSES))))


def word_digits(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    """The digits of words, of five bits each; the last may have fewer."""
    cut = [(at, min(5, bits - at)) for at in range(0, bits, 5)]
    return [((hashes >> np.uint64(40 + at)) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in cut]


def prefixes(of: np.ndarray, digits: list[np.ndarray]) -> list[np.ndarray]:
    """The class, the class and first digit, and so on to the number of the word bucket."""
    out = [of]
    for digit in digits:
        out.append(out[-1] * CLASSES + digit)
    return out


def class_log_probabilities(weights: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Natural logarithms of the class probabilities of tokens given by their features."""
    logits = _softmax_sums(weights, at)
    return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))


def _softmax_sums(weights: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of weights of all classes, for tokens given by their features, less the largest."""
    logits = weights.take(at[:, 0], axis=0)
    for k in range(1, at.shape[1]):
        logits += weights.take(at[:, k], axis=0)
    logits -= logits.max(axis=1, keepdims=True)
    return logits


class Trainer:
    """Adds up what texts give to the weights, at the weights that a model starts from."""

    def __init__(self, model: Model):
        self.model = model
        self.counts = np.zeros(BUCKETS * CLASSES, np.int64)
        self.sums = np.zeros(1 << WORD_BITS, np.complex128)
        # gradient and curvature of a bit of a node, which are met together and so lie together
        share = 1 / (1 + np.exp(-model.odds.astype(np.float64)))
        curvature = 1j * share * (1 - share)
        self.gives = np.stack([curvature - share, curvature - share + 1], 1).ravel().astype(np.complex64)

    @property
    def weights(self) -> np.ndarray:
        out = self.model.weights.copy()
        values = np.concatenate([self.counts, self.sums.astype(np.complex64).view(np.float32)])
        for _, part, learned in blocks():
            out[part] = stepped(self.model, part, values[learned])[0]
        return out

    def learn(self, found: np.ndarray, of: np.ndarray, buckets: np.ndarray) -> None:
        """Tokens of classes ``of`` and word ``buckets``; ``found`` has their contexts."""
        kinds, sums = word_contexts(found), np.zeros(1 << WORD_BITS, np.complex64)
        for i in range(0, len(of), BATCH):
            part = slice(i, i + BATCH)
            rows = class_features(found[part])
            np.add.at(self.counts, (rows * CLASSES + of[part, None]).ravel(), 1)
            at, nodes, bits = self.model.steps(buckets[part])
            gives = self.gives[2 * nodes + bits]
            for places in self.model.places(kinds[:, part], at, nodes):
                np.add.at(sums, places, gives)
        self.sums += sums

    def changes(self) -> Iterator[tuple[int, bytes]]:
        """(block, values): counts of features and classes, or sums of gradients and curvatures."""
        sums = self.sums.astype(np.complex64).view(np.float32)
        for block, (_, _, learned) in enumerate(blocks()):
            size = len(self.counts)
            values = self.counts[learned].astype(np.float32) if learned.stop <= size else sums[learned.start - size : learned.stop - size]
            if values.any():
                yield block, values.tobytes()


def stepped(model: Model, part: slice, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The weights of a block after the step, by what was added up for them, and what they met of
    it: the tokens of each feature, or the curvature of each weight."""
    if part.start < BUCKETS * CLASSES:
        counts, start = values.reshape(-1, CLASSES).astype(np.float64), parts_of(model.weights)[0][BUCKETS - 1].astype(np.float64)
        shares, met = np.exp(start) / np.exp(start).sum(), counts.sum(axis=1)
        with np.errstate(divide="ignore", invalid="ignore"):
            step = np.log((counts + PRIOR * shares) / (shares * (met[:, None] + PRIOR)))
        new = STEP * np.where(shares > 0, step, 0)
        if part.stop == BUCKETS * CLASSES:  # the constant feature has the shares at the start
            new[-1] = start
        return new.ravel(), met
    sums = values.reshape(-1, 2)
    return np.clip(WORD_STEP * sums[:, 0] / (sums[:, 1] + WORD_PRIOR), -WORD_MOST, WORD_MOST), sums[:, 1]


def parts_of(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The weights of classes, a row for each feature, and those of words."""
    return weights[: BUCKETS * CLASSES].reshape(BUCKETS, CLASSES), weights[BUCKETS * CLASSES :]


def blocks() -> list[tuple[slice, slice, slice]]:
    """The blocks of weights: of what they met, of themselves, and of the values that they are learned from."""
    n, size, words = BLOCK // CLASSES, BUCKETS * CLASSES, 1 << WORD_BITS
    of_classes = [(slice(i, i + n), *[slice(i * CLASSES, (i + n) * CLASSES)] * 2) for i in range(0, BUCKETS, n)]
    of_words = [(slice(BUCKETS + i, BUCKETS + i + BLOCK), slice(size + i, size + i + BLOCK), slice(size + 2 * i, size + 2 * (i + BLOCK))) for i in range(0, words, BLOCK)]
    return of_classes + of_words


def _training(docs: DataFrame) -> DataFrame:
    return docs.where(fold_of("id", HELD_OUT_FOLDS) != HELD_OUT_FOLD).select("text")


def corpus_counts(training: DataFrame) -> DataFrame:
    """(word, cell, n), of all training text: rows with a word hold its count, the others the
    count of a form with a neighbour (cell = form * 2 * NEIGHBOURS + neighbour's form, before or after)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(FORMS * 2 * NEIGHBOURS, np.int64)

        def rows(words: pa.Array, keys: pa.Array, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            for i in range(0, len(n), 50_000):
                part = words[i : i + 50_000].cast(pa.string()), keys[i : i + 50_000], pa.array(n[i : i + 50_000], pa.int64())
                yield pa.RecordBatch.from_arrays([*part], ["word", "cell", "n"])

        for batch in slices(batches, "text"):
            known = Tokens(batch.column("text"))
            at, starts = known.at, known.starts
            counts = np.bincount(at, minlength=len(known.words))
            yield from rows(known.words, pa.nulls(len(counts), pa.int64()), counts)
            forms = known.forms[at]
            inside = np.ones(len(at), bool)
            inside[starts] = False
            inside = np.flatnonzero(inside)
            here, previous = forms[inside], forms[inside - 1]
            cells += np.bincount(here * (2 * NEIGHBOURS) + previous % NEIGHBOURS, minlength=len(cells))
            cells += np.bincount(previous * (2 * NEIGHBOURS) + NEIGHBOURS + here % NEIGHBOURS, minlength=len(cells))
        found = np.flatnonzero(cells)
        yield from rows(pa.nulls(len(found), pa.string()), pa.array(found, pa.int64()), cells[found])

    return training.mapInArrow(run, "word string, cell bigint, n bigint").groupBy("word", "cell").agg(F.sum("n").alias("n"))


def form_classes(cells: np.ndarray, seed: int = SEED) -> np.ndarray:
    """A class for each form: k-means on the leading directions of its neighbours' shares."""
    totals = cells.sum(axis=1)
    draw = np.random.default_rng(seed)
    if not totals.any():
        return np.zeros(FORMS, np.int64)
    shares = cells / np.maximum(1, cells.sum(axis=0, keepdims=True)) ** 0.5
    shares = np.sqrt(shares / np.maximum(1e-12, shares.sum(axis=1, keepdims=True)))
    u, s, _ = np.linalg.svd(shares * np.sqrt(totals / totals.sum())[:, None], full_matrices=False)
    points = u[:, :24] * s[:24] / np.sqrt(np.maximum(1e-12, totals / totals.sum()))[:, None]
    points[totals == 0] = 0
    centres = points[draw.choice(len(points), CLASSES, replace=False, p=totals / totals.sum())] if (totals > 0).sum() >= CLASSES else points[np.argsort(-totals, kind="stable")[:CLASSES]]
    of = np.zeros(FORMS, np.int64)
    for _ in range(25):
        of = ((points[:, None, :] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        for c in range(CLASSES):
            mine = of == c
            if totals[mine].sum():
                centres[c] = (points[mine] * totals[mine, None]).sum(axis=0) / totals[mine].sum()
    return of


class Model:
    """What every task gets: head counts, classes of forms, totals of word buckets, weights."""

    def __init__(self, head: dict[str, int], classes: np.ndarray, tokens: int, distinct: int):
        self.head, self.classes, self.tokens, self.distinct = head, classes, tokens, distinct
        self.bits = bucket_bits(distinct)
        self.totals = np.ones(0)
        self.place = np.arange(0)
        self.weights = np.zeros(BUCKETS * CLASSES + (1 << WORD_BITS), np.float32)
        #: what each class feature and word weight was learned from: tokens, and curvature
        self.squares = np.zeros(BUCKETS + (1 << WORD_BITS), np.float32)

    def without(self, *names: str) -> Model:
        """A copy to be sent to tasks that do not need these."""
        out = copy(self)
        for name in names:
            setattr(out, name, None)
        return out

    def set_ranked(self, totals: np.ndarray) -> None:
        """As ``set_totals``, with the buckets of each class put in the order of their totals, largest
        first, so that words of like frequency share bits; ``place`` tells where a bucket went."""
        order = np.argsort(-totals.reshape(CLASSES, -1), axis=1, kind="stable")
        order += np.arange(CLASSES)[:, None] * order.shape[1]
        place = np.empty(len(totals), np.int32)
        place[order.ravel()] = np.arange(len(totals), dtype=np.int32)
        self.set_totals(totals[order.ravel()])
        self.place = place

    def buckets(self, known: Tokens) -> np.ndarray:
        """The bucket of each distinct word."""
        return self.place[prefixes(self.classes[known.forms], word_digits(known.hashes, self.bits))[-1]]

    def set_totals(self, totals: np.ndarray) -> None:
        """Sums of (count + 1) of the word buckets, from which all softmaxes start. A node is a
        class and the bits before a bit: those of no bits first, then those of one, and so on."""
        self.totals, sums, self.place = totals, totals, np.arange(len(totals), dtype=np.int32)
        odds, learned, logs = [], [], []
        with np.errstate(divide="ignore", invalid="ignore"):
            while len(sums) > CLASSES:
                two = sums.reshape(-1, 2)
                rarer, sums = two.min(axis=1), two.sum(axis=1)
                learned.append((rarer >= LEAST_COUNT) & (rarer >= LEAST_SHARE * sums))
                odds.append(np.where(learned[-1], np.log(two[:, 1] / two[:, 0]), 0).astype(np.float32))
            self.shares = np.where(totals > 0, np.log(totals / np.repeat(sums, len(totals) // CLASSES)), -1e30)
        self.depth = len(odds)
        self.odds = np.concatenate([np.empty(0, np.float32), *odds[::-1]])
        self.learned = np.concatenate([np.empty(0, bool), *learned[::-1]])
        for level in range(self.depth):  # what is left of a bucket's share beside that of the learned bits
            node = (np.arange(len(totals)) >> (self.depth - level)) + CLASSES * ((1 << level) - 1)
            sign = 1 - 2 * ((np.arange(len(totals)) >> (self.depth - 1 - level)) & 1)
            self.shares += np.where(self.learned[node], np.log1p(np.exp(sign * self.odds[node].astype(np.float64))), 0)
        # a node's number and CLASSES more has those of its children as twice that, and one more
        heap = np.arange(CLASSES, CLASSES << self.depth)
        depth = np.repeat(np.arange(self.depth), CLASSES << np.arange(self.depth)) % LEVELS
        self.roots = (mixed((heap >> depth).astype(np.uint64) * np.uint64(16) + _START) >> np.uint64(32)).astype(np.uint32)
        self.inside = ((1 << depth) | (heap & ((1 << depth) - 1))).astype(np.uint8)
        parts_of(self.weights)[0][BUCKETS - 1] = np.log(sums / sums.sum())

    def steps(self, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bits of word buckets that have weights: whose they are, their nodes and their values."""
        levels = np.arange(self.depth, dtype=np.int32)
        nodes = (buckets[:, None] >> (self.depth - levels)) + CLASSES * ((1 << levels) - 1)
        at, level = np.nonzero(self.learned.take(nodes))
        return at, nodes[at, level], (buckets[at] >> (self.depth - 1 - level)) & 1

    def places(self, kinds: np.ndarray, at: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """The weights of the features of tokens ``at`` at ``nodes``, a row for each kind of feature;
        those of a feature at the nodes of LEVELS levels below one lie together."""
        found = kinds.take(at, axis=1)
        found ^= self.roots.take(nodes)
        found *= _SPREAD
        found >>= np.uint32(32 - WORD_BITS + LEVELS)
        found <<= np.uint32(LEVELS)
        found |= self.inside.take(nodes)
        return found

    def log_probabilities(self, hashes: np.ndarray, starts: np.ndarray, of: np.ndarray, digits: list[np.ndarray]) -> np.ndarray:
        """Natural logarithms of the probabilities of each token's class and word bucket."""
        return self.bucket_log_probabilities(hashes, starts, of, prefixes(of, digits)[-1])

    def bucket_log_probabilities(self, hashes: np.ndarray, starts: np.ndarray, of: np.ndarray, buckets: np.ndarray) -> np.ndarray:
        found = contexts(hashes, starts)
        kinds = word_contexts(found)
        classes, words = parts_of(self.weights)
        out = self.shares[buckets]
        for i in range(0, len(of), BATCH):
            part = slice(i, i + BATCH)
            logits = _softmax_sums(classes, class_features(found[part]))
            out[part] += logits[np.arange(len(logits)), of[part]] - np.log(np.exp(logits).sum(axis=1))
            at, nodes, bits = self.steps(buckets[part])
            if not len(at):
                continue
            logits = self.odds[nodes] + words.take(self.places(kinds[:, part], at, nodes)).sum(axis=0)
            sign = (1 - 2 * bits).astype(np.float32)
            out[part] -= np.bincount(at, np.log1p(np.exp(np.clip(sign * logits, -80, 80))), len(buckets[part]))
        return out


def _bucket_totals(counts: DataFrame, classes: np.ndarray, bits: int) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                words = batch.column(0).cast(pa.large_string())
                of = prefixes(classes[_forms(words)], word_digits(array_hashes(words), bits))[-1]
                buckets, place = np.unique(of, return_inverse=True)
                sums = np.bincount(place, weights=batch.column(1).to_numpy() + 1.0)
                yield pa.RecordBatch.from_arrays([pa.array(buckets), pa.array(sums)], ["bucket", "z"])

    found = counts.select("word", "n").mapInArrow(run, "bucket bigint, z double").groupBy("bucket").agg(F.sum("z").alias("z")).toArrow()
    # one for unknown words in each bucket that there is
    whole, last = divmod(bits, 5)
    totals = np.ones((CLASSES ** (1 + whole), CLASSES if last else 1))
    totals[:, 1 << last :] = 0
    totals = totals.ravel()
    totals[found["bucket"].to_numpy()] += found["z"].to_numpy()
    return totals


def _round(model: Model, training: DataFrame) -> None:
    """The step over ``training``, from the model's weights.

    There are as many tasks as cores: a task's sums are as many rows however much it has
    read, so what is shuffled depends on the cores and not on the corpus."""
    training = training.coalesce(training.sparkSession.sparkContext.defaultParallelism)
    classes = model.classes
    sent = model.without("head", "totals", "shares", "squares")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = Trainer(sent)
        for batch in slices(batches, "text"):
            known = Tokens(batch.column("text"))
            found = contexts(known.hashes[known.at], known.starts)
            trainer.learn(found, classes[known.forms][known.at], sent.buckets(known)[known.at])
        for block, values in trainer.changes():
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([values], pa.binary())], ["block", "values"])

    def added(changes: pa.Table) -> pa.Table:
        whole = sum(np.frombuffer(values, np.float32).astype(np.float64) for values in changes["values"].to_pylist())
        return pa.table({"block": changes["block"][:1], "values": pa.array([whole.tobytes()], pa.binary())})

    sums = training.mapInArrow(run, "block int, values binary").groupBy("block")
    sums = sums.applyInArrow(added, "block int, values binary").toArrow()
    places, start = blocks(), copy(model)
    start.weights = model.weights.copy()
    for block, values in zip(*(column.to_pylist() for column in sums.columns), strict=True):
        met, part, _ = places[block]
        model.weights[part], model.squares[met] = stepped(start, part, np.frombuffer(values, np.float64))


def fit(docs: DataFrame) -> tuple[Model, DataFrame]:
    """The model of (id, text) rows outside the held-out fold, and the stored counts (word, n)."""
    corpus = materialize(corpus_counts(_training(docs)), "lm-corpus")
    counts = corpus.where("word IS NOT NULL").select("word", "n")
    size = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = counts.orderBy(F.desc("n"), "word").limit(HEAD).toArrow()
    head = dict(zip(top["word"].to_pylist(), top["n"].to_pylist(), strict=True))
    cells = np.zeros(FORMS * 2 * NEIGHBOURS)
    found = corpus.where("word IS NULL").select("cell", "n").toArrow()
    cells[found["cell"].to_numpy()] = found["n"].to_numpy()
    model = Model(head, form_classes(cells.reshape(FORMS, -1)), int(size[0]), int(size[1]))
    model.set_ranked(_bucket_totals(counts, model.classes, model.bits))
    _round(model, _training(docs))
    return model, counts


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of every row: id, held_out, n_tokens, n_known, train_tokens, base_score, score
    (log10 probability of the text and its end). Null text is empty: its end alone. Null ids
    count as empty text in the fold. Repeated rows are scored, and counted, each time.
    Without any training text, all tokens are unknown to both models."""
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    model, counts = fit(docs)
    kind = docs.schema["id"].dataType.simpleString()
    head, classes, sent = model.head, model.classes, model.without("head", "squares")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        log_totals = np.log10(sent.totals)
        head_words, head_counts = pa.array([*head, None], pa.large_string())[:-1], np.array([*head.values(), -1.0])
        for batch in slices(batches, "text"):
            known = Tokens(batch.column("text"))
            at, starts = known.at, known.starts
            buckets = sent.buckets(known)[at]
            logs = sent.bucket_log_probabilities(known.hashes[at], starts, classes[known.forms][at], buckets) / np.log(10)
            contextual = np.add.reduceat(logs - log_totals[buckets], starts) if len(starts) else np.empty(0)
            n = head_counts[pc.fill_null(pc.index_in(known.words, value_set=head_words), -1).to_numpy()][at]
            common = n >= 0
            logs = np.add.reduceat(np.where(common, np.log10(np.maximum(n, 0) + 1), 0), starts) if len(starts) else np.empty(0)
            ends = np.concatenate((starts[1:], [len(at)]))
            rare = np.flatnonzero(~common)
            offsets = np.searchsorted(rare, np.concatenate((starts, [len(at)])))
            words = known.words.take(pa.array(at[rare])).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(ends - starts, pa.int64()),
                    pa.array(np.add.reduceat(common, starts, dtype=np.int64) if len(starts) else [], pa.int64()),
                    pa.array(logs, pa.float64()),
                    pa.array(contextual, pa.float64()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), words),
                ],
                ["id", "n_tokens", "n_known", "logs", "contextual", "rare"],
            )

    made = docs.mapInArrow(run, f"id {kind}, n_tokens bigint, n_known bigint, logs double, contextual double, rare array<string>")
    made = materialize(made.withColumn("row", F.monotonically_increasing_id()), "lm-scores")
    # only rarer tokens are joined to their counts; their sums go back to the document's row
    rare = made.select("row", F.explode("rare").alias("word")).join(
        counts.where("word IS NOT NULL").withColumnRenamed("n", "count"), "word"
    )
    sums = rare.groupBy("row").agg(
        F.count("*").alias("rare_known"), F.sum(F.log10(F.col("count") + 1)).alias("rare_logs")
    )
    summed = made.drop("rare").join(sums, "row", "left").select(
        "id",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        (F.col("logs") + F.coalesce("rare_logs", F.lit(0.0))).alias("logs"),
        "contextual",
    )
    return summed.select(
        F.col("id").alias(id_col),
        (fold_of("id", HELD_OUT_FOLDS) == HELD_OUT_FOLD).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * F.log10(F.lit(float(model.tokens + model.distinct + 1)))).alias("base_score"),
        (F.col("logs") + F.col("contextual")).alias("score"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
