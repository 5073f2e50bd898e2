"""Token-id files: every id in the least number of bits that the vocabulary needs.

A file set is a Parquet folder of blocks and a small one of parts. A block holds
whole documents, about ``BLOCK_IDS`` ids, packed without gaps at a fixed width,
with the documents' offsets inside it, so numpy unpacks a block, or any range
of its ids, in one go, and a position is found from block starts alone. Parts are
contiguous ranges of documents in ascending id order; a part's start in the whole
is in the table of parts.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from nimbra.llm.common import slices, table, texts_of
from nimbra.llm.library_tokens import library_encoder, vocabulary_size
from nimbra.scratch import new_folder

BLOCK_IDS = 1 << 16
#: Text of a part, about, and the ids of a sample that are looked at to cut one off.
PART_BYTES = 32 << 20
SAMPLED_IDS = 30


def bits_for(vocabulary: int) -> int:
    return max(1, int(vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, width: int) -> bytes:
    """Each id in ``width`` bits, high bit first, padded with zeros to a whole byte."""
    if width in (8, 16, 32):
        return ids.astype(f">u{width // 8}").tobytes()
    bits = np.unpackbits(ids.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)
    return np.packbits(bits[:, 32 - width :].ravel()).tobytes()


def unpack_bits(payload: bytes, width: int, start: int, end: int) -> np.ndarray:
    """Ids ``start`` to ``end`` (exclusive) of a payload, reading only their bytes."""
    if width in (8, 16, 32):
        return np.frombuffer(payload, f">u{width // 8}", end - start, start * width // 8).astype("<u4")
    first = start * width // 8
    raw = np.frombuffer(payload, np.uint8)[first : -(-end * width // 8)]
    skip = start * width - first * 8
    bits = np.unpackbits(raw)[skip : skip + (end - start) * width].reshape(-1, width)
    wide = np.zeros((end - start, 32), np.uint8)
    wide[:, 32 - width :] = bits
    return np.packbits(wide, axis=1).view(">u4").ravel().astype("<u4")


def _cuts(plain: DataFrame) -> list:
    """Ids at which a part ends and the next one begins, in order."""
    rows, size = plain.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    parts = max(plain.sparkSession.sparkContext.defaultParallelism, -(-size // PART_BYTES))
    named = plain.select("id").where(F.col("id").isNotNull())
    share = min(1.0, SAMPLED_IDS * parts / max(1, rows))
    found = sorted(row["id"] for row in named.sample(share, seed=4).collect() if row["id"] == row["id"])
    return [found[len(found) * i // parts] for i in range(1, parts)] if found else []


def _places(cuts: list, key) -> tuple[int, int]:
    """The first and the last part that may hold ``key``: nulls come first, what is not a number last."""
    if key is None:
        return 0, 0
    if key != key:
        return len(cuts), len(cuts)
    return bisect_left(cuts, key), bisect_right(cuts, key)


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Encode every text (null: empty), append ``end_id`` to each, and write them in
    ascending order of ids (null first; rows of one id in any order, none lost).

    Ids are of any type that has an order, and are compared as they are. Parts hold about
    ``PART_BYTES`` of text; their boundaries are ids, quantiles of a sample of
    ``SAMPLED_IDS`` ids a part. Rows of an id that spans several boundaries are dealt over
    all the parts between them, so a repeated id does not make a large part.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    spark, cuts = docs.sparkSession, _cuts(plain)
    parts = len(cuts) + 1
    width = bits_for(max(vocabulary_size(tokenizer), end_id + 1))
    narrow = "<u2" if width <= 16 else "<u4"
    ending = np.array([end_id], "<u4").tobytes()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, turn = library_encoder(tokenizer), 0
        for batch in slices(batches, "text"):
            ids = [
                np.frombuffer(got + ending, "<u4").astype(narrow).tobytes()
                for got in encoder.encode(texts_of(batch, "text"))
            ]
            part = []
            for turn, key in enumerate(batch.column(0).to_pylist(), turn):  # noqa: B020
                low, high = _places(cuts, key)
                part.append(low + turn % (high - low + 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), batch.column(0), pa.array(ids, pa.binary())], ["part", "id", "ids"]
            )
        encoder.rest()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = {"part": None, "start": 0, "block": 0}

        def block(keys: list, ids: list[bytes]) -> pa.RecordBatch:
            offsets = np.cumsum([0, *(len(x) // np.dtype(narrow).itemsize for x in ids)])
            row = {
                "part": state["part"],
                "block": state["block"],
                "part_start": state["start"],
                "n_ids": int(offsets[-1]),
                "width": width,
                "keys": keys,
                "offsets": offsets,
                "payload": pack_bits(np.frombuffer(b"".join(ids), narrow), width),
            }
            state["start"] += int(offsets[-1])
            state["block"] += 1
            return pa.RecordBatch.from_pylist([row], schema=block_schema)

        block_schema = pa.schema(
            [
                ("part", pa.int32()),
                ("block", pa.int64()),
                ("part_start", pa.int64()),
                ("n_ids", pa.int64()),
                ("width", pa.int32()),
                ("keys", pa.list_(key_type)),
                ("offsets", pa.list_(pa.int32())),
                ("payload", pa.binary()),
            ]
        )
        keys, ids, size = [], [], 0
        for batch in batches:
            for part, key, got in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if ids and (part != state["part"] or size >= BLOCK_IDS):
                    yield block(keys, ids)
                    keys, ids, size = [], [], 0
                if part != state["part"]:
                    state.update(part=part, start=0, block=0)
                keys.append(key)
                ids.append(got)
                size += len(got) // np.dtype(narrow).itemsize
        if ids:
            yield block(keys, ids)

    from pyspark.sql.pandas.types import to_arrow_type

    key_type = to_arrow_type(docs.schema[id_col].dataType)
    (
        plain.mapInArrow(encoded, f"part int, id {kind}, ids binary")
        .repartitionById(parts, F.col("part"))
        .sortWithinPartitions("part", F.col("id").asc_nulls_first())
        .mapInArrow(
            blocks,
            "part int, block bigint, part_start bigint, n_ids bigint, width int, "
            f"keys array<{kind}>, offsets array<int>, payload binary",
        )
        .write.parquet(f"{path}/blocks")
    )
    # one row for each part: bounded by the number of parts, whatever the documents
    sizes = spark.read.parquet(f"{path}/blocks").groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    starts.coalesce(1).write.parquet(f"{path}/parts")


def _blocks(spark: SparkSession, path: str) -> DataFrame:
    parts = spark.read.parquet(f"{path}/parts").select("part", "start")
    found = spark.read.parquet(f"{path}/blocks").join(parts, "part")
    return found.withColumn("start", F.col("start") + F.col("part_start"))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(id, start, ids): one row for each document; ``ids`` are little-endian unsigned 32-bit bytes."""
    blocks = _blocks(spark, path).select("start", "width", "keys", "offsets", "payload")
    kind = blocks.schema["keys"].dataType.elementType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, width, keys, offsets, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = unpack_bits(payload, width, 0, offsets[-1])
                texts = [ids[a:b].tobytes() for a, b in zip(offsets, offsets[1:], strict=False)]
                starts = np.array(offsets[:-1], np.int64) + start
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, to_arrow_type(kind)), pa.array(starts), pa.array(texts, pa.binary())],
                    ["id", "start", "ids"],
                )

    from pyspark.sql.pandas.types import to_arrow_type

    return blocks.mapInArrow(run, f"id {kind.simpleString()}, start bigint, ids binary")


def read_range(spark: SparkSession, path: str, first: int, count: int) -> DataFrame:
    """(start, ids): the ids ``first`` to ``first + count`` of the whole, by blocks; other blocks are not read."""
    end = first + count
    wanted = _blocks(spark, path).where((F.col("start") < end) & (F.col("start") + F.col("n_ids") > first))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, n_ids, width, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                a, b = max(0, first - start), min(n_ids, end - start)
                got = unpack_bits(payload, width, a, b).tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([start + a], pa.int64()), pa.array([got], pa.binary())], ["start", "ids"]
                )

    return wanted.select("start", "n_ids", "width", "payload").mapInArrow(run, "start bigint, ids binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = new_folder(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return read_token_files(spark, path).select(
        F.col("id").alias("doc_id"),
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
