"""Byte-level BPE encoding and decoding with padded numpy matrices.

Pieces are the matches of the splitting pattern. Distinct pieces of a batch are
put into matrices by byte length, one row each, padded at the end. In every
round each row merges its leftmost pair of least rank: ranks of pairs come from
a hash table of pairs in numpy, the merged row is compacted by one place, and
rows without a pair of known rank leave the matrix. A matrix costs a round for every merge
of a row, so a piece of more than ``LONG_PIECE`` bytes (a run without white space) is merged
in linked form instead, in the same order, with a heap of its pairs.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from nimbra.llm.chunks import PATTERN, ChunkEncoder
from nimbra.llm.common import slices, table, texts_of

NO_RANK = np.int32(2**31 - 1)
PAD = -1
LONG_PIECE = 2048
#: A matrix has at most this many cells (rows are taken in several matrices beyond it).
MATRIX_CELLS = 1 << 21
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """(left id, right id) -> id of the merged token, by open addressing in numpy arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(left)) * 4))))
        self.mask = np.uint64((1 << self.bits) - 1)
        self.keys = np.full(1 << self.bits, 2**64 - 1, np.uint64)
        self.values = np.full(1 << self.bits, NO_RANK, np.int32)
        self.probes = 0
        keys = self._key(left, right)
        place = self._home(keys)
        todo = np.arange(len(keys))
        while len(todo):
            self.probes += 1
            free = self.keys[place[todo]] == np.uint64(2**64 - 1)
            _, winners = np.unique(place[todo][free], return_index=True)
            won = todo[free][winners]
            self.keys[place[won]], self.values[place[won]] = keys[won], merged[won]
            todo = todo[self.keys[place[todo]] != keys[todo]]
            place[todo] = (place[todo] + np.uint64(1)) & self.mask

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return (keys * _MULTIPLIER) >> np.uint64(64 - self.bits)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ids of merged pairs, which are their ranks; NO_RANK for others and for padding."""
        keys = self._key(np.maximum(left, 0), np.maximum(right, 0))
        place = self._home(keys)
        out = np.full(keys.shape, NO_RANK, np.int32)
        for _ in range(self.probes):
            found = self.keys[place]
            np.copyto(out, self.values[place], where=found == keys)
            if not np.any((found != keys) & (found != np.uint64(2**64 - 1))):
                break
            place = (place + np.uint64(1)) & self.mask
        out[(left < 0) | (right < 0)] = NO_RANK
        return out


class BytePairCodec:
    """Ranks of byte strings (``ranks``: bytes -> id; all single bytes included)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.findall = regex.compile(pattern).findall
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.ranks = ranks
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = [
            (ranks[token[:at]], ranks[token[at:]], rank)
            for token, rank in ranks.items()
            for at in range(1, len(token))
            if token[:at] in ranks and token[at:] in ranks
        ]
        self.pairs = PairTable(*np.array(pairs, np.int64).reshape(-1, 3).T)
        # with another pattern a text may not be cut at spaces, and is encoded as it is
        self.chunks = ChunkEncoder(self._encode_matches, self._encode_chunks) if pattern == PATTERN else None

    @classmethod
    def from_file(cls, path: str, pattern: str) -> BytePairCodec:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        return cls(ranks, pattern)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        encoded = self._encode_chunks(texts) if self.chunks is None else self.chunks.encode(texts)
        return [np.frombuffer(ids, np.int32) for ids in encoded]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))

    def _encode_matches(self, pieces: list[str]) -> list[bytes]:
        return self.encode_pieces([piece.encode() for piece in pieces])

    def _encode_chunks(self, chunks: list[str]) -> list[bytes]:
        cut = [self.findall(chunk) for chunk in chunks]
        distinct = list({piece for pieces in cut for piece in pieces})
        known = dict(zip(distinct, self._encode_matches(distinct), strict=True))
        return [b"".join(map(known.__getitem__, pieces)) for pieces in cut]

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece, as the bytes of 32-bit integers."""
        out: list = [None] * len(pieces)
        open_rows: dict[int, list[int]] = {}
        for row, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[row] = np.int32(whole).tobytes()
            elif len(piece) > LONG_PIECE:
                out[row] = self._merge_linked(piece)
            else:
                # buckets by length: a width of 1, 2, 3, 4, 6, 8, 12, 16, ... holds the piece
                n = max(1, len(piece))
                power = 1 << (n - 1).bit_length()
                open_rows.setdefault(power * 3 // 4 if power >= 4 and n <= power * 3 // 4 else power, []).append(row)
        for width, rows in open_rows.items():
            step = max(1, MATRIX_CELLS // width)
            for at in range(0, len(rows), step):
                part = rows[at : at + step]
                for row, ids in zip(part, self._merge([pieces[r] for r in part], width), strict=True):
                    out[row] = ids
        return out

    def _merge_linked(self, piece: bytes) -> bytes:
        """Always the leftmost pair of least rank, from a heap of (rank, place) in one integer;
        an entry whose pair has changed since is passed over."""
        rank_of, n = self.ranks.get, len(piece)
        parts: list[bytes] = [piece[i : i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [
            rank << 40 | at
            for at, pair in enumerate(map(bytes.__add__, parts, parts[1:]))
            if (rank := rank_of(pair)) is not None
        ]
        heapq.heapify(heap)
        while heap:
            entry = heapq.heappop(heap)
            at = entry & (1 << 40) - 1
            right = after[at]
            if not parts[at] or right >= n:
                continue
            pair = parts[at] + parts[right]
            if rank_of(pair) != entry >> 40:
                continue
            parts[at], parts[right] = pair, b""
            after[at] = beyond = after[right]
            if beyond < n:
                before[beyond] = at
                if (rank := rank_of(pair + parts[beyond])) is not None:
                    heapq.heappush(heap, rank << 40 | at)
            left = before[at]
            if left >= 0 and (rank := rank_of(parts[left] + pair)) is not None:
                heapq.heappush(heap, rank << 40 | left)
        return np.array([self.ranks[part] for part in parts if part], np.int32).tobytes()

    def _merge(self, pieces: list[bytes], width: int) -> list[bytes]:
        lengths = np.array([len(p) for p in pieces])
        joined = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        inside = np.arange(width) < lengths[:, None]
        ids = np.full((len(pieces), width), PAD, np.int32)
        ids[inside] = joined
        done: list = [None] * len(pieces)
        rows = np.arange(len(pieces))
        ranks = self.pairs.rank(ids[:, :-1], ids[:, 1:])
        while True:
            least = ranks.min(axis=1, initial=NO_RANK)
            ended = least == NO_RANK
            if ended.any():
                ends = (lengths[rows[ended]] * 4).tolist()
                for row, values, end in zip(rows[ended].tolist(), ids[ended], ends, strict=True):
                    done[row] = values.tobytes()[:end]
                ids, ranks, rows, least = (x[~ended] for x in (ids, ranks, rows, least))
            if not len(rows):
                return done
            lengths[rows] -= 1
            keep = int(lengths[rows].max())
            at = ranks.argmin(axis=1)  # the leftmost of the least
            here = np.arange(len(rows))
            ids[here, at] = least
            take = np.arange(keep) + (np.arange(keep) > at[:, None])
            ids = np.take_along_axis(ids, take, axis=1)
            ids[np.arange(keep) >= lengths[rows][:, None]] = PAD
            if keep < 2:
                ranks = np.full((len(rows), 1), NO_RANK, np.int32)
                continue
            ranks = np.take_along_axis(ranks, np.minimum(take[:, :-1], ranks.shape[1] - 1), axis=1)
            ranks[np.arange(keep - 1) >= lengths[rows][:, None] - 1] = NO_RANK
            for side in (at - 1, at):  # the pairs that the new token stands in
                ok = np.flatnonzero((side >= 0) & (side + 1 < keep))
                ranks[ok, side[ok]] = self.pairs.rank(ids[ok, side[ok]], ids[ok, side[ok] + 1])


_CODECS: dict[tuple[str, str], BytePairCodec] = {}


def codec(path: str, pattern: str) -> BytePairCodec:
    """One codec for each Python worker."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = BytePairCodec.from_file(path, pattern)
    return _CODECS[path, pattern]


def _encoded(batches: Iterator[pa.RecordBatch], bpe: BytePairCodec) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        ids = bpe.encode(texts_of(batch, "text"))
        offsets = np.cumsum([0, *map(len, ids)], dtype=np.int32)
        flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
        lists = pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32()))
        yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["id", "ids"])


def _decoded(batches: Iterator[pa.RecordBatch], bpe: BytePairCodec) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            lists = part.column(1)
            flat = lists.flatten().to_numpy()
            ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())
            texts = [bpe.decode(flat[a:b]) for a, b in zip([0, *ends[:-1]], ends, strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0), lists, pa.array(texts, pa.binary())], ["id", "ids", "bytes"])


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of every text, null read as empty (no ids). One row for
    each input row, repeated ids included; other columns are not read. No shuffle."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _encoded(batches, codec(path, pattern))

    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return plain.mapInArrow(run, f"id {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """Adds ``bytes`` to (id, ids): the bytes that the ids stand for."""
    kind = encoded.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _decoded(batches, codec(path, pattern))

    return encoded.mapInArrow(run, f"id {kind}, ids array<int>, bytes binary")


def encode_and_decode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What ``decode`` makes of ``encode``, in one Python worker for a task instead of two: each
    worker holds the vocabulary and remembers chunks."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path, pattern)
        yield from _decoded(_encoded(batches, bpe), bpe)
        pa.default_memory_pool().release_unused()  # the worker stays for other tasks

    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return plain.mapInArrow(run, f"id {kind}, ids array<int>, bytes binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    back = encode_and_decode(table(spark, sf_dir, "documents"), path, pattern)
    return back.select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )
