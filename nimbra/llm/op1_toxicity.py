"""Toxicity: terms of a learned lexicon, misspelled ones too, scored in their context.

The lexicon is learned from labelled documents: words that occur almost only in toxic
ones. A word's Levenshtein automaton, which accepts what lies within some edits of it, is
intersected with the trie of the lexicon: both are walked together and a branch ends where
the automaton has no state left. An index names the branches that a word can be near at
all, none for most words, so the walk is short. Hits are weighed by a window of words around them: quotation marks and
verbs of reporting speak for quotation, direct address for abuse.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from nimbra.llm.common import fold_of, lower, materialize, table, words_of
from nimbra.llm.op8_quality_classifier import training_rows

#: Bound of the labelled rows that are learned from (expected count).
TRAIN_ROWS = 20_000
#: A term occurs in so many toxic documents, and in so few others.
LEAST_TOXIC_DOCUMENTS = 3
LEAST_TOXIC_SHARE = 0.8
WINDOW = 6
FOLDS = 5
THRESHOLD = 0.5
SEED = 1
#: Letters of the texts whose words are looked up together.
LEARN_LETTERS = 4_000_000
#: Letters of the words that a Python worker remembers before it starts anew.
KEPT_LETTERS = 8_000_000

EDGES = " \t.,;:!?…\"'`´“”„‘’‚«»‹›()[]{}<>|*#$%&+=~^_/\\-–—0123456789"
OPENING, CLOSING = "\"'“„‘‚«‹", "\"'”“’‘»›"
# --- fixed word lists of the context window, by language: en, de, fr, es ---
REPORTING = frozenset(
    "said says wrote writes called calls quoted quote reported claimed allegedly word term "
    "sagte schrieb nannte zitat zitierte wort dit écrit appelé citation mot dijo escribió llamó cita palabra".split()
)
ADDRESS = frozenset("you your you're du dein deine ihr tu ton ta toi vous usted tú tus".split())


def allowed_edits(term: str) -> int:
    return 0 if len(term) < 4 else 1 if len(term) < 9 else 2


class Levenshtein:
    """The automaton of a word: states are the positions in it that are within ``limit``
    edits of what was read, as (position, edits) in order of positions."""

    def __init__(self, word: str, limit: int):
        self.word, self.limit = word, limit

    def start(self) -> list[tuple[int, int]]:
        return [(i, i) for i in range(min(self.limit, len(self.word)) + 1)]

    def step(self, state: list[tuple[int, int]], letter: str) -> list[tuple[int, int]]:
        out: list[tuple[int, int]] = []
        word, limit, end = self.word, self.limit, len(self.word)
        if state[0][0] == 0 and state[0][1] < limit:
            out.append((0, state[0][1] + 1))
        for j, (i, edits) in enumerate(state):
            if i == end:
                break
            edits += word[i] != letter
            if out and out[-1][0] == i and out[-1][1] + 1 < edits:
                edits = out[-1][1] + 1
            if j + 1 < len(state) and state[j + 1][0] == i + 1 and state[j + 1][1] + 1 < edits:
                edits = state[j + 1][1] + 1
            if edits <= limit:
                out.append((i + 1, edits))
        return out

    def accepted(self, state: list[tuple[int, int]]) -> int | None:
        """The edits of what was read, if it is within the limit."""
        return state[-1][1] if state and state[-1][0] == len(self.word) else None


#: Longer terms are filtered by their parts, shorter ones by what is left without some letters.
LONGEST_SHORTENED = 20


def _shortened(word: str, edits: int) -> set[str]:
    """The word, and what is left of it without up to ``edits`` letters."""
    out = last = {word}
    for _ in range(edits):
        last = {w[:i] + w[i + 1 :] for w in last for i in range(len(w))}
        out = out | last
    return out


def trie_of(terms: Iterable[str]) -> dict:
    trie: dict = {}
    for term in terms:
        node = trie
        for letter in term:
            node = node.setdefault(letter, {})
        node[""] = term
    return trie


class Lexicon:
    """Terms with weights, and an index of the branches of their trie that a word may be near.

    A word near a term has in common with it what is left of both without as many letters as
    there are edits; a swap of neighbours is found so too. Of a long term, one part in three
    stands whole in the word, nearly at its place. Lengths differ by the edits at most. What
    the index names is a trie of few branches; the automaton of the word decides on it.
    """

    def __init__(self, weights: dict[str, float], known: frozenset[str] = frozenset(), swaps: bool = False):
        """``known`` words are no misspellings; with ``swaps``, two neighbouring letters may be swapped."""
        import ahocorasick

        self.weights, self.known, self.swaps = weights, known, swaps
        self.shortened: dict[int, dict[str, list[str]]] = {1: {}, 2: {}}
        self.lengths: dict[int, set[int]] = {1: set(), 2: set()}
        parts: dict[str, list[tuple[int, str]]] = {}
        for term in weights:
            edits = allowed_edits(term)
            if not edits:
                continue
            if len(term) <= LONGEST_SHORTENED:
                for short in _shortened(term, edits):
                    self.shortened[edits].setdefault(short, []).append(term)
                self.lengths[edits].update(range(len(term) - edits, len(term) + edits + 1))
                continue
            cuts = [len(term) * p // (edits + 1) for p in range(edits + 2)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                parts.setdefault(term[a:b], []).append((a, term))
        self.parts = ahocorasick.Automaton()
        for part, places in parts.items():
            self.parts.add_word(part, (len(part), tuple(places)))
        if parts:
            self.parts.make_automaton()
        self.least_long = min((len(term) for places in parts.values() for _, term in places), default=math.inf) - 2

    def _near(self, word: str) -> set[str]:
        """Terms that the word may be near; most words have none."""
        out: set[str] = set()
        n = len(word)
        for edits, lengths in self.lengths.items():
            if n in lengths:
                index = self.shortened[edits]
                for short in index.keys() & _shortened(word, edits):
                    out.update(index[short])
        if n >= self.least_long:
            for last, (size, places) in self.parts.iter(word):
                start = last - size + 1
                out.update(t for place, t in places if abs(start - place) <= 2 and abs(n - len(t)) <= 2)
        return out

    def match(self, word: str) -> tuple[str, int] | None:
        """The term that a word is or misspells, and the edits: the fewest, then the largest weight."""
        if word in self.weights:
            return word, 0
        if word in self.known:
            return None
        near = self._near(word)
        if not near:
            return None
        best = self._swapped(word) if self.swaps else None
        automaton = Levenshtein(word, max(map(allowed_edits, near)))
        open_nodes = [(trie_of(near), automaton.start())]
        while open_nodes:
            node, state = open_nodes.pop()
            for letter, child in node.items():
                if letter == "":
                    edits = automaton.accepted(state)
                    if edits is not None and edits <= allowed_edits(child):
                        found = (edits, -self.weights[child], child)
                        best = found if best is None else min(best, found)
                else:
                    after = automaton.step(state, letter)
                    if after:
                        open_nodes.append((child, after))
        return (best[2], best[0]) if best else None

    def _swapped(self, word: str) -> tuple[int, float, str] | None:
        """The best term that a swap of two neighbouring letters gives, as one edit."""
        swaps = (word[:i] + word[i + 1] + word[i] + word[i + 2 :] for i in range(len(word) - 1))
        return min(((1, -self.weights[t], t) for t in swaps if t in self.weights and allowed_edits(t)), default=None)


_BASE = 0x100000001B3
_BACK = np.uint64(pow(_BASE, -1, 1 << 64))
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BITS = 25


def _places(values: np.ndarray) -> np.ndarray:
    return ((values * _MIX) >> np.uint64(64 - _BITS)).astype(np.int64)


class Sieve:
    """Marks at hashes of shortened terms: words without a mark are near no term.

    Hashes are polynomials in the letters, so those of a word without a letter or two come
    from its prefix sums, for all words of one length at once.
    """

    def __init__(self, lexicon: Lexicon):
        self.lengths, self.least_long = lexicon.lengths, lexicon.least_long
        self.marks = np.zeros(1 << _BITS, bool)
        by_length: dict[int, list[str]] = {}
        for index in lexicon.shortened.values():
            for short in index:
                by_length.setdefault(len(short), []).append(short)
        for n, shorts in by_length.items():
            self.marks[_places(self._sums(shorts, n)[n])] = True

    @staticmethod
    def _sums(words: list[str], n: int) -> list[np.ndarray]:
        """For each place, the sum over the letters before it of letter times base to its place."""
        letters = np.array(words, f"<U{max(n, 1)}").view(np.uint32).reshape(len(words), -1)
        sums, power = [np.zeros(len(words), np.uint64)], 1
        for k in range(n):
            sums.append(sums[-1] + (letters[:, k].astype(np.uint64) + np.uint64(1)) * np.uint64(power))
            power = power * _BASE % (1 << 64)
        return sums

    def _of_length(self, words: list[str], n: int) -> np.ndarray:
        sums = self._sums(words, n)
        found = self.marks[_places(sums[n])]
        for i in range(n):
            found |= self.marks[_places(sums[i] + _BACK * (sums[n] - sums[i + 1]))]
        if n in self.lengths[2]:
            for i in range(n):
                for j in range(i + 1, n):
                    rest = _BACK * (sums[j] - sums[i + 1] + _BACK * (sums[n] - sums[j + 1]))
                    found |= self.marks[_places(sums[i] + rest)]
        return found

    def near(self, words: list[str]) -> np.ndarray:
        """Whether a word may be near a term; never false for one that is."""
        out = np.zeros(len(words), bool)
        by_length: dict[int, list[int]] = {}
        for at, word in enumerate(words):
            by_length.setdefault(len(word), []).append(at)
        for n, members in by_length.items():
            if n >= self.least_long:
                out[members] = True
            elif n in self.lengths[1] or n in self.lengths[2]:
                out[members] = self._of_length([words[at] for at in members], n)
        return out


class Scanner:
    """Finds hits in texts, remembering words."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon, self.sieve = lexicon, Sieve(lexicon)
        self.seen: dict[str, tuple[str, int] | None] = {}
        self.letters = 0

    def learn(self, texts: Iterable[list[str]]) -> None:
        """Look up the words of several texts together."""
        if self.letters > KEPT_LETTERS:
            self.seen.clear()
            self.letters = 0
        new = list(set().union(*texts).difference(self.seen))
        if not new:
            return
        self.letters += sum(map(len, new))
        bare = [word.strip(EDGES) for word in new]
        found = self.seen
        found.update(dict.fromkeys(new))
        terms, match = self.lexicon.weights, self.lexicon.match
        near = self.sieve.near(bare)
        for word, core, may in zip(new, bare, near.tolist(), strict=True):
            if may or core in terms:
                found[word] = match(core)

    def hits(self, words: list[str]) -> list[tuple[int, str, int, bool, int, int]]:
        """(position, term, edits, quoted, reporting words near, words of address near)."""
        try:
            matches = list(map(self.seen.__getitem__, words))
        except KeyError:
            self.learn([words])
            matches = list(map(self.seen.__getitem__, words))
        out = []
        for at, found in enumerate(matches):
            if found is not None:
                before, after = words[max(0, at - WINDOW) : at + 1], words[at : at + WINDOW + 1]
                quoted = any(w[0] in OPENING for w in before) and any(w.rstrip(".,;:!?")[-1:] in CLOSING and w.rstrip(".,;:!?") for w in after)
                near = [w.strip(EDGES) for w in before[:-1] + after[1:]]
                out.append((at, *found, quoted, sum(w in REPORTING for w in near), sum(w in ADDRESS for w in near)))
        return out

    def all_hits(self, texts: list[str | None]) -> Iterator[tuple[list[str], list[tuple]]]:
        """The words and the hits of each text, a few texts at a time (null: empty)."""
        cut, letters = [], 0
        for at, text in enumerate(texts):
            cut.append(words_of(lower(text or "")))
            letters += len(text or "")
            if letters >= LEARN_LETTERS or at + 1 == len(texts):
                self.learn(cut)
                yield from ((words, self.hits(words)) for words in cut)
                cut, letters = [], 0

    def features(self, text: str) -> list[float]:
        return self.all_features([text])[0]

    def all_features(self, texts: list[str | None]) -> list[list[float]]:
        return [self.measures(words, hits) for words, hits in self.all_hits(texts)]

    def measures(self, words: list[str], hits: list[tuple]) -> list[float]:
        open_hits = [h for h in hits if not (h[3] or h[4])]
        by_edits = [sum(h[2] == e for h in open_hits) for e in range(3)]
        return [
            *(math.log1p(n) for n in by_edits),
            math.log1p(len(hits) - len(open_hits)),
            math.log1p(sum(h[5] for h in hits)),
            max((self.lexicon.weights[h[1]] / (1 + h[2]) for h in hits), default=0.0),
            100 * len(hits) / max(1, len(words)) / 10,
        ]


N_FEATURES = 7
_SCANNERS: dict[str, Scanner] = {}


class Model:
    def __init__(self, weights: dict[str, float], known: list[str], coefficients: list[float]):
        self.weights, self.known, self.coefficients = weights, known, coefficients
        self.token = uuid.uuid4().hex

    def scanner(self) -> Scanner:
        """One for each Python worker, which remembers the words of its earlier tasks."""
        if self.token not in _SCANNERS:
            _SCANNERS.clear()
            _SCANNERS[self.token] = Scanner(Lexicon(self.weights, frozenset(self.known), swaps=True))
        return _SCANNERS[self.token]

    def score(self, features: list[float]) -> float:
        value = self.coefficients[0] + sum(c * x for c, x in zip(self.coefficients[1:], features, strict=True))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, value))))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Coefficients, the constant first, by Newton steps with a ridge (not on the constant)."""
    x = np.column_stack([np.ones(len(x)), x])
    penalty = np.diag([1e-3] + [ridge] * (x.shape[1] - 1))
    b = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        b -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (p - y) + penalty @ b)
    return b


def _distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = {word.strip(EDGES) for word in words_of(lower(text or ""))}
            words.discard("")
            yield pa.RecordBatch.from_arrays([pa.array(list(words), pa.string()), pa.array([label] * len(words), pa.int32())], ["word", "label"])


def fit(labelled: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Learn from (text, label), at most about ``rows`` of them drawn evenly: three quarters
    give the lexicon, the rest the weights of the features. Without any toxic or any other
    row the lexicon is empty and the score is the share of toxic rows."""
    labelled = labelled.where(F.col("label").isin(0, 1))
    count = labelled.count()
    drawn = labelled.select("text", F.col("label").cast("int").alias("label"), F.rand(SEED).alias("draw"))
    held = materialize(drawn.where(F.rand(SEED + 1) < min(1.0, rows / max(1, count))), "toxicity-train")
    totals = held.where("draw < 0.75").agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    n, toxic = int(totals[0]), int(totals[1])
    if not 0 < toxic < n:
        share = (toxic + 0.5) / (n + 2)
        return Model({}, [], [math.log(share / (1 - share))] + [0.0] * N_FEATURES)
    stats = (
        held.where("draw < 0.75")
        .select("text", "label")
        .mapInArrow(_distinct_words, "word string, label int")
        .groupBy("word")
        .agg(F.sum("label").alias("bad"), F.count("*").alias("n"))
    )
    stats = materialize(stats, "toxicity-words")
    odds = F.log((F.col("bad") + 0.5) / toxic) - F.log((F.col("n") - F.col("bad") + 0.5) / (n - toxic))
    terms = (
        stats.where((F.col("bad") >= LEAST_TOXIC_DOCUMENTS) & (F.col("bad") >= LEAST_TOXIC_SHARE * F.col("n")))
        .select("word", odds.alias("weight"))
        .collect()
    )
    weights = {row["word"]: float(row["weight"]) for row in terms}

    def misspelt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(weights, swaps=True)
        sieve = Sieve(lexicon)
        for batch in batches:
            words = batch.column(0).to_pylist()
            may = sieve.near(words).tolist()
            near = [m and w not in weights and lexicon.match(w) is not None for m, w in zip(may, words, strict=True)]
            near = pa.array(near, pa.bool_())
            yield pa.RecordBatch.from_arrays([c.filter(near) for c in batch.columns], batch.schema.names)

    # words near a term that other documents use are words of their own
    known = [
        row["word"]
        for row in stats.select("word", "bad", "n")
        .where(F.col("bad") < 0.5 * F.col("n"))
        .mapInArrow(misspelt, "word string, bad bigint, n bigint")
        .collect()
    ]

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(Lexicon(weights, frozenset(known), swaps=True))
        for batch in batches:
            made = scanner.all_features(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.list_(pa.float64())), batch.column(1)], ["x", "label"])

    rest = held.where("draw >= 0.75").select("text", "label").mapInArrow(measured, "x array<double>, label int").toArrow()
    y = rest["label"].to_numpy()
    x = np.array(rest["x"].to_pylist()).reshape(len(y), N_FEATURES)
    if not 0 < y.sum() < len(y):  # too few rows to weigh features: a hit of a sure term decides
        return Model(weights, known, [-3.0, 2.0, 1.0, 0.5, 0.5, 0.0, 0.5, 0.0])
    return Model(weights, known, logistic(x, y).tolist())


_HITS = ArrayType(
    StructType(
        [
            StructField("position", LongType()),
            StructField("term", StringType()),
            StructField("edits", IntegerType()),
            StructField("quoted", BooleanType()),
        ]
    )
)


def scores(model: Model, text: Column) -> Column:
    """Scores of a text column (null: empty): 0 to 1, higher where toxic is likelier. A score
    depends on the text alone, so repeated rows get the same one and null ids do not matter."""

    @F.pandas_udf(DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = model.scanner()
        for texts in batches:
            yield pd.Series([model.score(x) for x in scanner.all_features(list(texts))], dtype="float64")

    return score(text)


def spans(model: Model, text: Column) -> Column:
    """The hits of a text: word position, term, edits and whether it stands in quotation."""

    @F.pandas_udf(_HITS)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = model.scanner()
        for texts in batches:
            hits = [hits for _, hits in scanner.all_hits(list(texts))]
            yield pd.Series([[{"position": h[0], "term": h[1], "edits": h[2], "quoted": h[3]} for h in hh] for hh in hits])

    return found(text)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(training_rows(docs, table(spark, sf_dir, "labels"), "toxic", TRAIN_ROWS))
    return docs.select(
        "doc_id", (fold_of("doc_id", FOLDS) == 0).alias("held_out"), scores(model, F.col("text")).alias("score")
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
