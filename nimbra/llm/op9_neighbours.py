"""Exact nearest neighbours by a block matrix join of int8 tiles.

Queries and candidates are dealt into blocks of bounded size, whatever their values,
and each pair of blocks is one tile. In a tile, vectors are scaled to int8; the product
of the int8 matrices gives every inner product up to a bound that follows from the
norms of what rounding left out. Candidates whose upper bound reaches the k-th largest
lower bound survive, are computed anew in double precision, and the best k of each
query leave the tile. A query's lists from all its tiles are merged by a heap.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from nimbra.llm.common import table

QUERY_BLOCK = 4096
CANDIDATE_BLOCK = 8192
#: Queries of a tile that are taken at once, and survivors computed at once.
ROWS_AT_ONCE = 256
PAIRS_AT_ONCE = 1 << 16
#: Products of int8 are summed exactly in single precision up to this many dimensions.
SINGLE_DIMENSIONS = (1 << 24) // (127 * 127)


def searchable(vector: Column) -> Column:
    """Not null, all components present and finite, one of them not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def quantised(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 values, the scale of each row, the norms of what they stand for and of the rest."""
    scale = np.abs(vectors).max(axis=1) / 127
    # a scale that underflows: such rows stand as zero, and the whole vector is the rest
    rounded = np.rint(np.divide(vectors, scale[:, None], out=np.zeros_like(vectors), where=scale[:, None] > 0))
    near = rounded * scale[:, None]
    return rounded.astype(np.int8), scale, np.linalg.norm(near, axis=1), np.linalg.norm(vectors - near, axis=1)


def exact(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of rows, summed in the order of the components in double precision."""
    return np.add.accumulate(left * right, axis=1)[:, -1]


def best_of_tile(
    queries: np.ndarray, query_ids: np.ndarray, candidates: np.ndarray, ids: np.ndarray, k: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query: its row, ids and scores of its nearest candidates, nearest first."""
    order = np.argsort(ids, kind="stable")  # ties go to the smaller id
    candidates, ids = candidates[order], ids[order]
    a, a_scale, a_norm, a_rest = quantised(queries)
    b, b_scale, b_norm, b_rest = quantised(candidates)
    kind = np.float32 if queries.shape[1] <= SINGLE_DIMENSIONS else np.float64
    turned = b.astype(kind).T
    for at in range(0, len(queries), ROWS_AT_ONCE):
        rows = slice(at, at + ROWS_AT_ONCE)
        near = (a[rows].astype(kind) @ turned).astype(np.float64) * (a_scale[rows, None] * b_scale)
        reach = a_norm[rows, None] * b_rest + a_rest[rows, None] * (b_norm + b_rest)
        reach += 1e-12 * (a_norm[rows, None] + a_rest[rows, None]) * (b_norm + b_rest)
        own = query_ids[rows, None] == ids
        lower = np.where(own, -np.inf, near - reach)
        if len(ids) > k:
            least = np.partition(lower, len(ids) - k, axis=1)[:, len(ids) - k]
        else:
            least = np.full(len(lower), -np.inf)
        row, column = np.nonzero((near + reach >= least[:, None]) & ~own)
        scores = np.concatenate(
            [np.empty(0)]
            + [
                exact(queries[at + row[i : i + PAIRS_AT_ONCE]], candidates[column[i : i + PAIRS_AT_ONCE]])
                for i in range(0, len(row), PAIRS_AT_ONCE)
            ]
        )
        starts = np.searchsorted(row, np.arange(len(lower) + 1))
        for i in range(len(lower)):
            mine = slice(starts[i], starts[i + 1])
            best = np.argsort(-scores[mine], kind="stable")[:k]
            yield at + i, ids[column[mine][best]], scores[mine][best]


def nearest(queries: DataFrame, candidates: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, id, score): the ``k`` candidates of largest inner product for every
    query row, all if fewer, ties to the smaller id.

    Rows whose vector is null, empty, zero or holds a null or non-finite component, and
    rows without an id, take no part. Candidates with the query's own id are left out;
    only vectors of the query's length are compared. A repeated query row gets its own
    result; a repeated candidate counts as often as it occurs.
    """
    spark = queries.sparkSession

    def plain(frame: DataFrame) -> DataFrame:
        return frame.select(
            F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")
        ).where(F.col("id").isNotNull() & searchable(F.col("v")))

    queries, candidates = plain(queries), plain(candidates)
    turn = F.monotonically_increasing_id()

    def block(count: int) -> Column:
        # int on both sides: Spark deals an int and a bigint of one value to different tasks
        return F.pmod(turn, F.lit(count)).cast("int")

    q_blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    c_blocks = max(1, -(-candidates.count() // CANDIDATE_BLOCK))
    left = queries.select(
        F.size("v").alias("dim"), turn.alias("row"), "id", "v", block(q_blocks).alias("qb")
    ).withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(c_blocks - 1))))
    right = candidates.select(F.size("v").alias("dim"), "id", "v", block(c_blocks).alias("cb"))
    right = right.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))

    def tile(ours: pa.Table, theirs: pa.Table) -> pa.Table:
        columns: list[list] = [[], [], [], []]
        if ours.num_rows and theirs.num_rows:
            row, query_ids = ours["row"].to_numpy(), ours["id"].to_numpy()
            for i, ids, scores in best_of_tile(
                _matrix(ours["v"]), query_ids, _matrix(theirs["v"]), theirs["id"].to_numpy(), k
            ):
                for column, value in zip(columns, (row[i], query_ids[i], ids, scores), strict=True):
                    column.append(value)
        kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.float64()))
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["row", "query_id", "ids", "scores"])

    lists = (
        left.groupBy("qb", "cb", "dim")
        .cogroup(right.groupBy("qb", "cb", "dim"))
        .applyInArrow(tile, "row bigint, query_id bigint, ids array<bigint>, scores array<double>")
    )

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flow = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        for (_, query_id), tiles in groupby(flow, key=lambda row: row[:2]):
            heap: list[tuple[float, int]] = []  # the k best so far, the worst on top; ids negated for ties
            for _, _, ids, scores in tiles:
                for entry in zip(scores, (-i for i in ids), strict=True):
                    if len(heap) < k:
                        heapq.heappush(heap, entry)
                    elif entry > heap[0]:
                        heapq.heapreplace(heap, entry)
                    else:
                        break  # the rest of this tile's list is no nearer
            best = sorted(heap, reverse=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([query_id] * len(best), pa.int64()),
                    pa.array(range(1, len(best) + 1), pa.int32()),
                    pa.array([-i for _, i in best], pa.int64()),
                    pa.array([score for score, _ in best], pa.float64()),
                ],
                ["query_id", "rank", "id", "score"],
            )

    dealt = lists.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "row").sortWithinPartitions("row")
    return dealt.mapInArrow(merged, "query_id bigint, rank int, id bigint, score double")


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = np.concatenate([chunk.flatten().to_numpy() for chunk in column.chunks])
    return flat.reshape(len(column), -1)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors.where("vec_id % 20 = 0"), vectors, 20).withColumnRenamed("id", "vec_id")


ORACLE = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) = len(list_filter(embedding, lambda x: isfinite(x)))
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""
