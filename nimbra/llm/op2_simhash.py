"""SimHash near-duplicates: documents linked at a small bit distance, and their classes.

Equal fingerprints are one node from the start, so a group of copies of any size is
one row. Nodes get a pivot distance table: the Hamming distance of each quarter of
the fingerprint to ``PIVOTS`` reference fingerprints. By the triangle inequality no
coordinate of two fingerprints within d bits differs by more than d; and as d <= 2
bits touch at most two quarters, all coordinates of some two quarters are equal. So
nodes are joined on the coordinates of each two quarters, pairs whose greatest
coordinate difference over the whole table exceeds d are discarded, and the
survivors' own distance decides.

A set of coordinates that more than ``CELL`` nodes share is not paired up: its nodes
and the fingerprints one bit from them are listed, and nodes that list a fingerprint
in common are linked. Two balls of radius one meet exactly if their centres are at
most two bits apart, so this finds the same links with 65 rows for each node.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType

from nimbra.llm.common import lower, materialize, table, words_of

SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 2
#: Reference fingerprints.
PIVOTS = 16
#: Nodes that share coordinates are compared in pairs up to this many.
CELL = 256

_QUARTERS = [0xFFFF << (16 * q) for q in range(4)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def fingerprint(text: str, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """The SimHash of a text's word shingles, as a signed 64-bit integer."""
    found = words_of(lower(text))
    if not found:
        return 0
    joined = " ".join(found).encode()
    whole = memoryview(joined)
    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    size = min(words, len(found))
    starts = np.concatenate(([0], spaces + 1))[: len(found) - size + 1].tolist()
    ends = np.concatenate((spaces, [len(joined)]))[size - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(whole[a:b], seed) for a, b in zip(starts, ends, strict=True)], "<u8")
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    # sums of up to 255 rows fit a byte
    partial = np.add.reduceat(bits, np.arange(0, len(bits), 255), axis=0, dtype=np.uint8)
    ones = partial.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<i8")[0])


@F.pandas_udf(LongType())
def _fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([fingerprint(text or "") for text in texts], dtype="int64")


def fingerprints(text: Column) -> Column:
    """Fingerprints of a text column; null reads as empty, whose fingerprint is zero."""
    return _fingerprints(text)


def pivot_table(nodes: DataFrame, seed: int = SEED) -> DataFrame:
    """Adds ``pivots``, the distances to the reference fingerprints, and ``cells``, a
    hash of the coordinates of each two quarters (equal coordinates, equal hash)."""
    draw = random.Random(seed)
    references = [F.lit(_signed(draw.getrandbits(64))) for _ in range(PIVOTS)]
    masks = [F.lit(_signed(mask)) for mask in _QUARTERS]
    quarter = [
        [F.bit_count(F.col("fp").bitwiseXOR(ref).bitwiseAND(mask)).cast("byte") for ref in references] for mask in masks
    ]
    named = nodes.select(
        "*",
        *(F.bit_count(F.col("fp").bitwiseXOR(ref)).cast("byte").alias(f"p{j}") for j, ref in enumerate(references)),
        *(F.xxhash64(*quarter[q]).alias(f"q{q}") for q in range(4)),
    )
    pairs = [(a, b) for a in range(4) for b in range(a + 1, 4)]
    cells = F.array(*(F.xxhash64(F.lit(4 * a + b), f"q{a}", f"q{b}") for a, b in pairs))
    return named.withColumn("cells", cells).drop(*(f"q{q}" for q in range(4)))


def links(nodes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges (a, b), a < b, whose classes are those of all pairs of distinct ``fp`` within ``max_bits``."""
    if not 0 <= max_bits <= 2:
        raise ValueError("quarters keep two equal only for at most 2 differing bits")
    pivots = [f"p{j}" for j in range(PIVOTS)]
    cells = pivot_table(nodes.select("fp")).select("fp", *pivots, F.explode("cells").alias("cell"))
    sizes = cells.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1")
    shared = materialize(cells.join(sizes, "cell"), "simhash-cells")

    small = shared.where(F.col("n") <= CELL)
    left = small.select("cell", F.col("fp").alias("a"), *(F.col(p).alias(f"a_{p}") for p in pivots))
    right = small.select("cell", F.col("fp").alias("b"), *(F.col(p).alias(f"b_{p}") for p in pivots))
    furthest = F.greatest(*(F.abs(F.col(f"a_{p}") - F.col(f"b_{p}")) for p in pivots))
    near = (
        left.join(right, "cell")
        .where((F.col("a") < F.col("b")) & (furthest <= max_bits))
        .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
        .select("a", "b")
    )

    crowded = shared.where(F.col("n") > CELL).select("fp").distinct()
    flips = F.array(F.lit(0).cast("long"), *(F.lit(_signed(1 << b)) for b in range(64 if max_bits else 0)))
    listed = crowded.select("fp", F.explode(flips).alias("flip")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("point")
    )
    if max_bits < 2:  # balls that only touch are too far apart then: listed points that are nodes themselves
        other = crowded.select(F.col("fp").alias("point"))
        star = listed.where("fp < point").join(other, "point").select(F.col("fp").alias("a"), F.col("point").alias("b"))
    else:
        # a point is listed by itself and by its 64 neighbours at most: groups are bounded
        met = listed.groupBy("point").agg(F.sort_array(F.collect_set("fp")).alias("fps")).where(F.size("fps") > 1)
        star = met.select(F.get("fps", F.lit(0)).alias("a"), F.explode(F.slice("fps", 2, 64)).alias("b"))
    return near.unionByName(star).distinct()


def classes(edges: DataFrame) -> DataFrame:
    """(fp, root): the least node that each linked node reaches, by stars.

    Alternately every node's greater neighbours, then its smaller ones, are linked to
    the least neighbour; the edges end as one star for each class. A round costs two
    joins on node ids; a centre with many edges is a skewed join, which Spark splits.
    """
    edges = materialize(edges.select("a", "b"), "simhash-edges")
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").where("a < b").distinct()
        down = large.select(F.col("b").alias("u"), F.col("a").alias("v"))
        lower_least = down.groupBy("u").agg(F.min("v").alias("m"))
        moved = down.join(lower_least, "u")
        edges = materialize(
            moved.select(F.col("m").alias("a"), F.col("v").alias("b"))
            .unionByName(lower_least.select(F.col("m").alias("a"), F.col("u").alias("b")))
            .where("a < b")
            .distinct(),
            "simhash-edges",
        )
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == mark:
            return edges.select(F.col("b").alias("fp"), F.col("a").alias("root"))
        mark = now


def components(rows: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Adds ``component`` to (key, fp): the least key of the row's class (nulls last; null
    if all are). ``rows`` is read several times and should be a stored table."""
    nodes = materialize(rows.groupBy("fp").agg(F.min("key").alias("key")), "simhash-nodes")
    roots = classes(links(nodes, max_bits))
    rooted = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    firsts = rooted.groupBy("root").agg(F.min("key").alias("component"))
    of_fp = rooted.join(firsts, "root").select("fp", "component")
    return rows.join(of_fp, "fp")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS
) -> DataFrame:
    """(id, fp, component) for each row: a signed fingerprint and the least id reachable.

    Empty and null texts, and texts without a word, have fingerprint zero and are linked
    like any other. Rows with a null id take part; their component may be null. Repeated
    rows give repeated results. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("key"), fingerprints(F.col(text_col)).alias("fp"))
    found = components(materialize(rows, "simhash-rows"), max_bits)
    return found.select(F.col("key").alias(id_col), "fp", F.col("component"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` with all their columns, one for each class: that of the least
    id (null ids last), one of them where an id is repeated."""
    names = docs.columns
    held = docs.select(F.struct(*(F.col(f"`{n}`") for n in names)).alias("row"), F.col(text_col).alias("text"))
    keyed = held.select(
        "row",
        F.struct(
            F.col(f"row.`{id_col}`").isNull().alias("missing"),
            F.col(f"row.`{id_col}`").alias("id"),
            F.monotonically_increasing_id().alias("turn"),
        ).alias("key"),
        fingerprints(F.col("text")).alias("fp"),
    )
    stored = materialize(keyed, "simhash-documents")
    found = components(stored.select("key", "fp"), max_bits)
    kept = found.where(F.col("key") == F.col("component")).select(F.col("key.turn").alias("turn"))
    return stored.join(kept, stored["key.turn"] == kept["turn"], "left_semi").select("row.*")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_first(docs)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )
