"""Packing documents into sequences of several context sizes.

A document's ids are cut into windows of the longest context as far as they go;
the rest goes to the smallest context (tier) that holds it. From the longest tier
down, each remainder opens a window of its tier, and the gap is filled from
shorter tiers: first the longest remainders that fit, then one cut to size, whose
other part goes back to the tier that it now fits. At the end of a task a window
that nothing is left for is cut into powers of two, so no sequence is padded.
Windows of a tier are dealt into step groups of equal token count, the costly
ones (by the sum of squared piece lengths, the cost of attention) evenly.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from nimbra.llm.common import slices, table, texts_of
from nimbra.llm.library_tokens import library_encoder

CONTEXTS = (256, 512, 1024, 2048)
#: Tokens of remainders that a task holds before it packs them.
POOL_TOKENS = 1 << 20
#: Tokens of a step group.
STEP_TOKENS = 1 << 17

Piece = tuple[object, int, bytes, int]  # document id, start in the document, ids, tokens of the document


class TierPacker:
    """Packs pieces within one task. ``windows`` takes finished windows: (context, pieces)."""

    def __init__(self, contexts: tuple[int, ...]):
        self.contexts = sorted(contexts)
        self.longest = self.contexts[-1]
        self.by_length: list[list[Piece]] = [[] for _ in range(self.longest + 1)]
        self.lengths = 0  # bit n is set if there are pieces of n ids
        self.pooled = 0
        self.windows: list[tuple[int, list[Piece]]] = []

    def add(self, key, ids: bytes) -> None:
        n = len(ids) // 4
        whole = n - n % self.longest
        for at in range(0, whole, self.longest):
            self.windows.append((self.longest, [(key, at, ids[4 * at : 4 * (at + self.longest)], n)]))
        if whole < n:
            self._put((key, whole, ids[4 * whole :], n))

    def _put(self, piece: Piece) -> None:
        n = len(piece[2]) // 4
        self.by_length[n].append(piece)
        self.lengths |= 1 << n
        self.pooled += n

    def _take(self, n: int) -> Piece:
        piece = self.by_length[n].pop()
        if not self.by_length[n]:
            self.lengths &= ~(1 << n)
        self.pooled -= n
        return piece

    def _longest_upto(self, n: int) -> int:
        return (self.lengths & ((2 << n) - 1)).bit_length() - 1

    def pack(self, last: bool) -> None:
        """Pack the pool; unless it is the last time, pieces of an unfilled window stay."""
        for tier in range(len(self.contexts) - 1, -1, -1):
            context, shorter = self.contexts[tier], self.contexts[tier - 1] if tier else 0
            while (n := self._longest_upto(context)) > shorter:
                window, gap = [self._take(n)], context - n
                while gap and self.lengths:
                    fit = self._longest_upto(gap)
                    if fit > 0:
                        window.append(self._take(fit))
                        gap -= fit
                    else:  # all are longer than the gap: cut the shortest
                        key, start, ids, total = self._take((self.lengths & -self.lengths).bit_length() - 1)
                        window.append((key, start, ids[: 4 * gap], total))
                        self._put((key, start + gap, ids[4 * gap :], total))
                        gap = 0
                if gap and not last:
                    for piece in window:
                        self._put(piece)
                    return
                if gap:
                    self._powers(window, context - gap)
                else:
                    self.windows.append((context, window))

    def whole_groups(self, step_tokens: int) -> list[tuple[int, list[Piece]]]:
        """Takes out the windows that fill step groups of their context; the others wait."""
        waiting = Counter(context for context, _ in self.windows)
        room = {context: n - n % max(1, step_tokens // context) for context, n in waiting.items()}
        taken, left = [], []
        for window in self.windows:
            room[window[0]] -= 1
            (taken if room[window[0]] >= 0 else left).append(window)
        self.windows = left
        return taken

    def _powers(self, pieces: list[Piece], tokens: int) -> None:
        """Cut what is left into sequences of descending powers of two."""
        pieces = pieces[::-1]
        while tokens:
            size = 1 << (tokens.bit_length() - 1)
            window, gap = [], size
            while gap:
                key, start, ids, total = pieces.pop()
                n = min(gap, len(ids) // 4)
                window.append((key, start, ids[: 4 * n], total))
                if 4 * n < len(ids):
                    pieces.append((key, start + n, ids[4 * n :], total))
                gap -= n
            self.windows.append((size, window))
            tokens -= size


def step_groups(windows: list[tuple[int, list[Piece]]], step_tokens: int) -> list[int]:
    """A group number for each window: one context in a group, ``step_tokens`` tokens
    (fewer in the last), windows by descending cost dealt back and forth."""
    out, first = [0] * len(windows), 0
    by_context: dict[int, list[int]] = {}
    for at, (context, _) in enumerate(windows):
        by_context.setdefault(context, []).append(at)
    for context in sorted(by_context, reverse=True):
        members = by_context[context]
        members.sort(key=lambda at: -sum((len(p[2]) // 4) ** 2 for p in windows[at][1]))
        groups = -(-len(members) * context // step_tokens)
        for rank, at in enumerate(members):
            turn, place = divmod(rank, groups)
            out[at] = first + (groups - 1 - place if turn % 2 else place)
        first += groups
    return out


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    contexts: tuple[int, ...] = CONTEXTS,
) -> DataFrame:
    """Pack every document (null text: empty; its end id alone is packed then).

    Returns one row for each piece: the id column, start, length, ids (little-endian
    unsigned 32-bit), doc_tokens, sequence_id, offset, context, step_group. Documents
    are packed where they are read, without a shuffle: every task has sequences of its
    own, numbered from its partition. Repeated ids are packed as often as they occur.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    ending = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        encoder, packer = library_encoder(tokenizer), TierPacker(contexts)
        sequence = group = TaskContext.get().partitionId() << 32
        key_type = to_arrow_type(key_kind)

        def finished(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal sequence, group
            windows = packer.windows if last else packer.whole_groups(STEP_TOKENS)
            groups = step_groups(windows, STEP_TOKENS)
            columns: list[list] = [[] for _ in range(9)]
            for (context, pieces), step in zip(windows, groups, strict=True):
                offset = 0
                for key, start, ids, total in pieces:
                    n = len(ids) // 4
                    row = (key, start, n, ids, total, sequence, offset, context, group + step)
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
                    offset += n
                sequence += 1
            group += max(groups, default=-1) + 1
            kinds = (key_type, *(pa.int64(),) * 2, pa.binary(), *(pa.int64(),) * 3, pa.int32(), pa.int64())
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
            for at in range(0, len(arrays[0]), 2000):
                yield pa.RecordBatch.from_arrays([a.slice(at, 2000) for a in arrays], NAMES)

        for batch in slices(batches, "text"):
            for key, ids in zip(batch.column(0).to_pylist(), encoder.encode(texts_of(batch, "text")), strict=True):
                packer.add(key, ids + ending)
            if packer.pooled >= POOL_TOKENS:
                packer.pack(last=False)
            yield from finished(last=False)
        packer.pack(last=True)
        yield from finished(last=True)
        encoder.rest()

    key_kind = docs.schema[id_col].dataType
    packed = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run,
        f"id {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, "
        "sequence_id bigint, offset bigint, context int, step_group bigint",
    )
    return packed.withColumnRenamed("id", id_col)


NAMES = ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "context", "step_group"]


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=1)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = stage(spark, table(spark, sf_dir, "documents"), sf_dir)
    return packed.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
        "context",
        "step_group",
    )
