"""Operator 2: exact top-k inner products by aggregation without random access.

For a query, component j of all vectors of a block is a list sorted by its
share of the score. The lists are read in step from their best ends. A vector's
score is at least what was read of it plus the worst of the lists it was not
yet read in, and at most that plus their current fronts. Reading stops when few
vectors can still reach the k-th best lower bound (or the k-th best score of
the blocks before); only their final scores are resolved exactly.

The queries are a stated set: they are taken in waves of at most ``WAVE``
vectors, each broadcast, and all vectors are passed once per wave. A task
keeps k results a query over its blocks; a ranking per query merges the tasks.

Components become floor(``SCALE`` * x) as doubles, and products are summed
exactly: in doubles where the block's bound allows, else in Python integers.

Defined results: vectors that are null or hold null, NaN or infinite components
take no part; vectors meet queries of their own length only (an empty vector
scores 0); a query id given by several rows stands for its largest vector; all
rows but those of the query's own id are candidates, repeated ones as often as
they occur; ties go to the smaller id. Rows with a null id take no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

K = 10
SCALE = 1024
WAVE = 16_384
BLOCK = 8_192
DEPTHS = (0.125, 0.25, 0.375, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
EXACT = float(1 << 53)


class Block:
    """Vectors of one length with their sorted lists."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x = ids, x
        self.largest = float(np.abs(x).max()) if x.size else 0.0
        down = np.argsort(-x, axis=0, kind="stable").T          # list j: rows by falling component
        values = np.take_along_axis(x.T, down, 1) if x.size else x.T
        self.rows = np.stack([down, down[:, ::-1]]).astype(np.int32)
        self.values = np.stack([values, values[:, ::-1]])
        self.place = np.argsort(down, axis=1, kind="stable").T if x.size else x   # row, list: place from the top


def exact(x: np.ndarray, q: np.ndarray, largest: float) -> np.ndarray:
    """Inner products as integers."""
    if largest * float(np.abs(q).max(initial=0.0)) * max(len(q), 1) < EXACT:
        return (x @ q).astype(np.int64)
    whole = [int(v) for v in q]
    return np.array([sum(int(a) * b for a, b in zip(row, whole)) for row in x], np.int64)


def search(block: Block, q: np.ndarray, own: int, k: int, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """(rows, scores) of a block that may be among the best k; ``reach``: a score they must attain."""
    n, d = block.x.shape
    lists = np.flatnonzero(q)
    mine = block.ids == own
    if n <= 4 * k or not len(lists):
        rows = np.flatnonzero(~mine)
        return rows, exact(block.x[rows], q, block.largest)
    slack = 1e-9 * block.largest * float(np.abs(q).sum()) + 0.5   # doubles may round; scores are integers
    side = (q[lists] < 0).astype(np.int64)
    w = q[lists]
    rows_of, values_of = block.rows[side, lists], block.values[side, lists]
    worst = w * values_of[:, -1]
    got = np.zeros(n)
    at = 0
    for part in DEPTHS:
        to = min(n, max(at + 1, math.ceil(part * n)))
        got += np.bincount(rows_of[:, at:to].ravel(), (w[:, None] * values_of[:, at:to]).ravel(), n)
        at = to
        front = w * values_of[:, at - 1]
        seen = np.bincount(rows_of[:, :at].ravel(), np.repeat(front, at), n)
        upper = got + (front.sum() - seen)
        upper[mine] = -np.inf
        # Lower bounds of the most promising vectors are enough for the k-th best.
        ahead = np.argpartition(-upper, 4 * k)[:4 * k]
        place = block.place[np.ix_(ahead, lists)]
        unread = np.where(side == 0, place >= at, place < n - at)
        lower = got[ahead] + unread @ worst
        lower[mine[ahead]] = -np.inf
        bound = max(reach, float(np.partition(lower, -k)[-k])) - slack
        rows = np.flatnonzero(upper >= bound)
        if len(rows) <= max(4 * k, n // 64) or at == n:
            break
    return rows, exact(block.x[rows], q, block.largest)


def _vectors(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(places, floor(SCALE * x)) for each length of the vectors in a list column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    length = np.asarray(column.value_lengths())
    flat = np.asarray(column.flatten()).astype(np.float64)
    begin = np.cumsum(length) - length
    out = []
    for d in np.unique(length):
        at = np.flatnonzero(length == d)
        cells = begin[at][:, None] + np.arange(d)
        out.append((at, np.floor(SCALE * flat[cells]) if d else np.zeros((len(at), 0))))
    return out


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec) of the rows that take part."""
    fine = F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (vectors.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull())
            .where(F.coalesce(fine, F.lit(False)))
            .select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec")))


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def top_k(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
          k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: the best k of ``vectors`` for each row of ``queries``."""
    spark = vectors.sparkSession
    asked = usable(queries, id_col, vec_col).groupBy("id").agg(F.max("vec").alias("vec"))
    waves = max(1, math.ceil(asked.count() / (WAVE * 0.9)))
    every = usable(vectors, id_col, vec_col)
    found = None
    for wave in range(waves):
        got = asked.where(F.pmod(F.xxhash64("id"), F.lit(waves)) == wave).orderBy("id").toArrow()
        ids = got.column("id").to_numpy()
        sets = {x.shape[1]: (ids[at], x) for at, x in _vectors(got.column("vec"))} if len(ids) else {}
        shared = spark.sparkContext.broadcast(sets)

        def searched(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            asked = shared.value
            best = {d: [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(q[0]) for d, q in asked.items()}
            for batch in batches:
                for at in range(0, batch.num_rows, BLOCK):
                    part = batch.slice(at, BLOCK)
                    own = part.column("id").to_numpy()
                    for where, x in _vectors(part.column("vec")):
                        if x.shape[1] not in asked:
                            continue
                        block = Block(own[where], x)
                        for i, (qid, q) in enumerate(zip(*asked[x.shape[1]])):
                            old_ids, old = best[x.shape[1]][i]
                            rows, s = search(block, q, qid, k, float(old[-1]) if len(old) == k else -math.inf)
                            all_ids, all_s = np.concatenate([old_ids, block.ids[rows]]), np.concatenate([old, s])
                            top = _best(all_ids, all_s, k)
                            best[x.shape[1]][i] = all_ids[top], all_s[top]
            for d, (qids, _) in asked.items():
                if best[d]:
                    size = [len(s) for _, s in best[d]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(qids, size)), pa.array(np.concatenate([i for i, _ in best[d]])),
                         pa.array(np.concatenate([s for _, s in best[d]]))], ["query_id", "vec_id", "score"])

        some = every.mapInArrow(searched, "query_id long, vec_id long, score long")
        found = some if found is None else found.unionByName(some)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
