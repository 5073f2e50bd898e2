"""The prefix trie of conversations, from their sorted order.

A turn is known by a digest of role and text, a prefix by the digest chained over its turns,
and a conversation by the chained digests in a row. Sorted, the members of every prefix stand
next to each other. Ranges of the sorted rows are blocks of bounded size; in a block the
lengths of the prefixes common to neighbours (LCPs) go into a sparse table of range minima,
and every candidate prefix finds its first and last member by a binary search of its own to
the left and to the right. A prefix that goes on in other blocks has a row for each of them,
and these rows are added up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from nimbra.llm.common import fold_of, materialize, table

#: Bytes of a digest of a turn or a prefix.
WIDTH = 16
#: Turns of a block, about.
TURNS_OF_BLOCK = 100_000

_KEYED = "conv_id bigint, key binary, words array<int>"
_FOUND = (
    "node binary, parent binary, depth bigint, conv_id bigint, n_convs bigint, n_children bigint, "
    "n_leaves bigint, saved_tokens bigint, part bigint, ends string"
)
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def turns_of(conversations: DataFrame) -> DataFrame:
    """One row per conversation: conv_id and its turns (turn, digest, words) in order.

    Null roles and texts are empty; a null turn comes first, and turns of one number follow
    the order of their digests, so repeated rows stay and their order is defined. Rows
    without a conv_id belong to no conversation. Other columns play no part."""
    role, text = [F.coalesce(F.col(name), F.lit("")) for name in ("role", "text")]
    marked = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turn = F.struct(
        F.col("turn"),
        F.unhex(F.substring(F.sha2(marked, 256), 1, 2 * WIDTH)).alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).alias("words"),
    )
    named = conversations.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("bigint"), turn.alias("t"))
    return named.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def rebuilt(conversations: DataFrame, family: int = 20, most: int = 4) -> DataFrame:
    """Conversations that open with the first turns of the first one of their family: crc32 of
    the id, modulo ``most``, of them, in place of as many turns of their own."""
    own = turns_of(conversations).withColumn("first id", F.col("conv_id") - F.col("conv_id") % family)
    heads = own.where(F.col("conv_id") == F.col("first id")).select(
        "first id", F.slice("turns", 1, most - 1).alias("head")
    )
    h = fold_of("conv_id", most).cast("int")
    head = F.slice(F.coalesce("head", F.slice("turns", 1, 0)), F.lit(1), h)
    rest = F.slice("turns", h + 1, F.size("turns"))
    return own.join(heads, "first id", "left").select("conv_id", F.concat(head, rest).alias("turns"))


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests chained over the turns, joined to one key."""

    def link(prefix: bytes, turn: bytes) -> bytes:
        return hashlib.blake2b(prefix + turn, digest_size=WIDTH).digest()

    for batch in batches:
        turns = batch.column(1).to_pylist()
        keys = [b"".join(list(accumulate((t["digest"] for t in row), link, initial=b""))[1:]) for row in turns]
        words = [[t["words"] for t in row] for row in turns]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(keys, pa.binary()), pa.array(words, pa.list_(pa.int32()))],
            names=["conv_id", "key", "words"],
        )


def common_length(a: bytes, b: bytes) -> int:
    """Turns that two keys have in common; chained digests agree up to there and nowhere after."""
    low, high = 0, min(len(a), len(b)) // WIDTH
    while low < high:
        middle = (low + high + 1) // 2
        at = slice((middle - 1) * WIDTH, middle * WIDTH)
        low, high = (middle, high) if a[at] == b[at] else (low, middle - 1)
    return low


class RangeMinimum:
    """Sparse table: row k has the minima of all stretches of 2^k values."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        while (half := 1 << (len(self.rows) - 1)) * 2 <= len(values):
            last = self.rows[-1]
            self.rows.append(np.minimum(last[: len(last) - half], last[half:]))

    def minimum(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Of the values from ``first`` to ``last``, both included."""
        level = np.frexp(last - first + 1)[1] - 1
        out = np.empty(len(first), self.rows[0].dtype)
        for k in np.unique(level):
            at = level == k
            row = self.rows[k]
            out[at] = np.minimum(row[first[at]], row[last[at] - (1 << int(k)) + 1])
        return out

    def reach_right(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The furthest index to the right of ``at`` up to which, ``at`` left out, no value is below ``least``."""
        reach, n = at.copy(), len(self.rows[0])
        for k in reversed(range(len(self.rows))):
            step = np.flatnonzero(reach + (1 << k) < n)
            step = step[self.rows[k][reach[step] + 1] >= least[step]]
            reach[step] += 1 << k
        return reach

    def reach_left(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The furthest index to the left of ``at`` such that no value after it, up to ``at``, is below ``least``."""
        reach = at.copy()
        for k in reversed(range(len(self.rows))):
            step = np.flatnonzero(reach >= 1 << k)
            step = step[self.rows[k][reach[step] - (1 << k) + 1] >= least[step]]
            reach[step] -= 1 << k
        return reach


def _prefixes(part: int, ids: np.ndarray, keys: list[bytes], words: list, before: bytes | None, after: bytes | None) -> pa.Table:
    """Every prefix of the sorted rows of one block, with what the block knows of its subtree.

    ``before`` and ``after`` are the keys next to the block, null at the ends of the order.
    """
    n = len(keys)
    lengths = np.array([len(key) // WIDTH for key in keys], np.int64)
    lcp = np.full(n + 1, -1, np.int64)  # lcp[i]: turns common to rows i - 1 and i
    lcp[1:n] = [common_length(a, b) for a, b in zip(keys, keys[1:], strict=False)]
    lcp[0] = -1 if before is None else common_length(before, keys[0])
    lcp[n] = -1 if after is None else common_length(keys[-1], after)

    # words of the first k turns of row i: totals[start[i] + k]
    start = np.concatenate([[0], np.cumsum(lengths + 1)])
    flat = np.zeros(start[-1], np.int64)
    for i, row in enumerate(words):
        flat[start[i] + 1 : start[i + 1]] = row
    totals = np.cumsum(flat)
    totals -= np.repeat(totals[start[:-1]], lengths + 1)

    # a row brings the prefixes that the row before it in the block has not
    known = lcp[:n].copy()
    known[0] = -1
    count = lengths - known
    first_candidate = np.concatenate([[0], np.cumsum(count)])
    row = np.repeat(np.arange(n), count)
    depth = np.arange(first_candidate[-1]) - first_candidate[row] + known[row] + 1

    minima = RangeMinimum(lcp[:n])
    left, right = minima.reach_left(row, depth), minima.reach_right(row, depth)

    # a prefix that stood in an earlier block is that block's child of its parent
    new = np.flatnonzero((depth > lcp[row]) & (depth > 0))
    parent_row = minima.reach_left(row[new], depth[new] - 1)
    children = np.zeros(len(row), np.int64)
    np.add.at(children, first_candidate[parent_row] + depth[new] - 1 - known[parent_row] - 1, 1)

    # leaves: sequences that the next row does not go on with
    leaf = np.concatenate([[0], np.cumsum(lcp[1:] < lengths)])
    # a row after the first of a subtree repeats the turns from its depth to the common length
    repeated = np.concatenate([[0], np.cumsum(totals[start[:-1] + np.maximum(lcp[:n], 0)])])
    first_repeats = (left == 0) & (lcp[0] >= depth)
    from_row = np.where(first_repeats, left, left + 1)
    above = np.where(depth > 0, totals[start[row] + np.maximum(depth - 1, 0)], 0)
    saved = repeated[right + 1] - repeated[from_row] - (right + 1 - from_row) * above

    same_as_next = np.array([a == b for a, b in zip(keys, keys[1:], strict=False)] + [False], bool)
    last_equal = np.flatnonzero(~same_as_next)
    ends: list[str | None] = [None] * len(row)
    for c in np.flatnonzero(depth == lengths[row]):
        i = row[c]
        ends[c] = ",".join(map(str, ids[i : last_equal[np.searchsorted(last_equal, i)] + 1]))

    def prefix(i: int, d: int) -> bytes:
        return keys[i][max(d - 1, 0) * WIDTH : d * WIDTH]

    pairs = list(zip(row.tolist(), depth.tolist(), strict=True))
    return pa.table(
        {
            "node": pa.array([prefix(i, d) for i, d in pairs], pa.binary()),
            "parent": pa.array([prefix(i, d - 1) if d else None for i, d in pairs], pa.binary()),
            "depth": depth,
            "conv_id": RangeMinimum(ids).minimum(left, right),
            "n_convs": right - left + 1,
            "n_children": children,
            "n_leaves": leaf[right + 1] - leaf[left],
            "saved_tokens": saved,
            "part": np.full(len(row), part, np.int64),
            "ends": pa.array(ends, pa.string()),
        }
    )


def _block(rows: pa.Table, edges: pa.Table) -> pa.Table:
    keys, ids = rows["key"].to_pylist(), rows["conv_id"].to_numpy()
    order = sorted(range(len(keys)), key=lambda i: (keys[i], ids[i]))
    words = rows["words"].to_pylist()
    return _prefixes(
        edges["part"][0].as_py(),
        ids[order],
        [keys[i] for i in order],
        [words[i] for i in order],
        edges["before"][0].as_py(),
        edges["after"][0].as_py(),
    )


def _end_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by node and part; a list of any length is read through, not held."""
    node, state = None, None
    for batch in batches:
        done = []
        for at, ends in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if at != node or state is None:
                if state is not None:
                    done.append((node, state.hexdigest()))
                node, state = at, hashlib.sha256(ends.encode())
            else:
                state.update(b"," + ends.encode())
        yield _digest_batch(done)
    if state is not None:
        yield _digest_batch([(node, state.hexdigest())])


def _digest_batch(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())],
        names=["node", "ends_sha256"],
    )


def trie(conversations: DataFrame, turns_of_block: int = TURNS_OF_BLOCK) -> DataFrame:
    """Nodes of the trie of ``conversations`` (conv_id, turns as by ``turns_of``), with their digest
    ``node``: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256. A conversation without turns is a member of the root; without
    conversations there is no node. Equal conversations are members of the same nodes."""
    keyed = materialize(conversations.select("conv_id", "turns").mapInArrow(_chain, _KEYED), "trie-keys")
    turns = keyed.agg(F.sum(F.size("words") + 1)).first()[0] or 0
    parts = max(keyed.sparkSession.sparkContext.defaultParallelism, -(-turns // turns_of_block))
    ordered = materialize(
        keyed.repartitionByRange(parts, "key", "conv_id").withColumn("part", F.spark_partition_id().cast("bigint")),
        "trie-order",
    )
    # one row for each block
    along = Window.orderBy("part")
    edges = ordered.groupBy("part").agg(F.min("key").alias("first"), F.max("key").alias("last")).select(
        "part", F.lag("last").over(along).alias("before"), F.lead("first").over(along).alias("after")
    )
    found = materialize(ordered.groupBy("part").cogroup(edges.groupBy("part")).applyInArrow(_block, _FOUND), "trie-blocks")

    # a table, as Spark splits the many children of one parent only in a join of tables
    nodes = materialize(
        found.groupBy("node", "parent", "depth").agg(
            F.min("conv_id").alias("conv_id"),
            *[F.sum(name).alias(name) for name in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        ),
        "trie-nodes",
    )
    ends = found.where(F.col("ends").isNotNull()).select("node", "part", "ends")
    ends = ends.repartition("node").sortWithinPartitions("node", "part")
    ends = ends.mapInArrow(_end_digests, "node binary, ends_sha256 string")
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (
        nodes.join(parents, "parent", "left")
        .join(ends, "node", "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(_NO_ENDS)).alias("ends_sha256"), "node",
        )
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(rebuilt(table(spark, sf_dir, "conversations"))).drop("node")


ORACLE = r"""
WITH t AS (
  SELECT conv_id, turn, sha256(strlen(COALESCE(role, '')) || ':' || COALESCE(role, '') || COALESCE(text, '')) AS s,
         len(regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+')) AS w
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list(struct_pack(s := s, w := w) ORDER BY turn NULLS FIRST, s) AS turns,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
                                                                 lambda x: CAST(ascii(x) AS BIGINT))),
                         lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]),
                                                  lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384)
                                                                    ELSE v // 2 END)), 4294967295) % 4 AS h
  FROM t GROUP BY conv_id
), c AS (
  SELECT o.conv_id, list_concat(CASE WHEN o.h > 0 THEN COALESCE(b.turns, [])[1:o.h] ELSE [] END, o.turns[o.h + 1:]) AS turns
  FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20
), p AS (
  SELECT conv_id, d, len(turns) = d AS here, turns[d].w AS w,
         CASE WHEN d = 0 THEN [] ELSE list_transform(turns[1:d], lambda x: x.s) END AS k
  FROM (SELECT conv_id, turns, UNNEST(range(0, len(turns) + 1)) AS d FROM c)
), n AS (
  SELECT k, d, min(conv_id) AS conv_id, count(*) AS n_convs, COALESCE(any_value(w), 0) AS w,
         sha256(COALESCE(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE here), '')) AS ends_sha256
  FROM p GROUP BY k, d
), kids AS (
  SELECT CASE WHEN d = 1 THEN [] ELSE k[1:d - 1] END AS k, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1
), whole AS (
  SELECT n.*, COALESCE(n_children, 0) AS n_children FROM n LEFT JOIN kids USING (k)
), sums AS (
  SELECT k, sum(saved) AS saved_tokens, sum(leaf) AS n_leaves FROM (
    SELECT CASE WHEN a = 0 THEN [] ELSE k[1:a] END AS k, saved, leaf FROM (
      SELECT k, UNNEST(range(0, d + 1)) AS a, (n_convs - 1) * w AS saved,
             CASE WHEN n_children = 0 THEN 1 ELSE 0 END AS leaf FROM whole)) GROUP BY 1
)
SELECT CAST(v.conv_id AS BIGINT) AS conv_id, CAST(v.d AS BIGINT) AS depth, CAST(u.conv_id AS BIGINT) AS parent_conv_id,
       CAST(v.n_convs AS BIGINT) AS n_convs, CAST(v.n_children AS BIGINT) AS n_children,
       CAST(sums.n_leaves AS BIGINT) AS n_leaves, CAST(sums.saved_tokens AS BIGINT) AS saved_tokens, v.ends_sha256
FROM whole v JOIN sums USING (k)
LEFT JOIN whole u ON v.d > 0 AND u.d = v.d - 1 AND u.k = (CASE WHEN v.d = 1 THEN [] ELSE v.k[1:v.d - 1] END)
"""
