"""Exact k-nearest-neighbour classification on Spark.

Neighbour search is a block nested-loop join. Query and reference rows are
hashed into blocks; every (query block, reference block) pair is a tile, whose
task holds the query block and streams the references past it. Numpy computes a
strip of distances at a time and keeps, per query, only the k nearest so far;
one merge per query then joins the tiles' lists. Pairs never become rows, no
cross join runs, and the result is exact (ties broken by distance, then
reference id).

That work is quadratic; it parallelises over tiles = (#query blocks) x
(#reference blocks) x (#groups). ``pivot_neighbours`` is for data with clusters: the
references are partitioned by their nearest pivot, and the triangle inequality
rules out the cells that cannot hold a neighbour, so most tiles are never formed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldstat.session import materialise

KERNELS = ("rectangular", "triangular", "gaussian", "inv")

_NEIGHBOUR_SCHEMA = "g long, qid long, rid long, rlabel string, dist double"


def to_vector(cols: Sequence[str]) -> Column:
    """Feature columns to one array<double> column."""
    return F.array(*[F.col(c).cast("double") for c in cols])


def dim_stats(df: DataFrame, vec: str = "vec", groups: Sequence[str] = ()) -> DataFrame:
    """Per-dimension mean and sample sd as arrays (one row per group; d entries each).
    sd 0 or NULL becomes 1, as the reference's scaler did."""
    ex = df.select(*groups, F.posexplode(vec).alias("pos", "x"))
    per = ex.groupBy(*groups, "pos").agg(F.avg("x").alias("m"), F.stddev_samp("x").alias("s"))
    per = per.withColumn("s", F.coalesce(F.when(F.col("s") != 0, F.col("s")), F.lit(1.0)))
    arr = F.sort_array(F.collect_list(F.struct("pos", "m", "s")))
    g = per.groupBy(*groups).agg(arr.alias("_st"))
    return g.select(*groups, F.col("_st.m").alias("mean"), F.col("_st.s").alias("sd"))


def _standardise(vec: Column, mean: Column, sd: Column) -> Column:
    idx = F.sequence(F.lit(0), F.size(vec) - 1)
    return F.transform(idx, lambda i: (F.get(vec, i) - F.get(mean, i)) / F.get(sd, i))


def scale_with(train: DataFrame, other: DataFrame, vec: str = "vec", out: str | None = None) -> DataFrame:
    """K3: standardise ``other`` with the statistics of ``train``. The statistics are one
    row of two d-length arrays (bounded by the dimension, not the data); they are read
    once and applied as literal arrays, so the scaling stays a narrow projection."""
    row = dim_stats(train, vec).first()
    m = F.array(*[F.lit(float(x)) for x in row["mean"]])
    s = F.array(*[F.lit(float(x)) for x in row["sd"]])
    return other.withColumn(out or vec, _standardise(F.col(vec), m, s))


def fold_scaled(train: DataFrame, fold: str, vec: str = "vec") -> tuple[DataFrame, DataFrame]:
    """Standardise for cross-validation: fold f's queries and its references (all other
    folds) use the statistics of the other folds. Returns (queries, references), both
    with a group column ``g`` = the query fold; references are replicated once per
    other fold. Each fold's (n, mean, squares about the mean) is found in one pass and
    merged over the other folds, so no difference of large sums is taken."""
    fold_ids = sorted(r_[0] for r_ in train.select(fold).distinct().collect())          # k values
    others = F.explode(F.filter(F.array(*[F.lit(int(x)).cast("long") for x in fold_ids]),
                                lambda g: g != F.col(fold).cast("long")))
    ex = train.select(fold, F.posexplode(vec).alias("pos", "x"))
    per = ex.groupBy(fold, "pos").agg(F.count("x").alias("n"), F.avg("x").alias("m"),
                                      F.coalesce(F.var_samp("x"), F.lit(0.0)).alias("v"))
    # (n, mean, squares about the mean) of the other folds merged; k squared x d rows.
    per = per.withColumn("g", others)
    whole = per.groupBy("g", "pos").agg((F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("mean"), F.sum("n").alias("n_all"))
    around = F.col("m") - F.col("mean")
    c = per.join(whole, ["g", "pos"]).groupBy("g", "pos").agg(
        F.max("mean").alias("m"), F.sqrt(F.try_divide(F.sum((F.col("n") - 1) * F.col("v") + F.col("n") * around * around),
                                                      F.max("n_all") - 1)).alias("sd"))
    c = c.withColumn("sd", F.coalesce(F.when(F.col("sd") != 0, F.col("sd")), F.lit(1.0)))
    st = c.groupBy("g").agg(F.sort_array(F.collect_list(F.struct("pos", "m", "sd"))).alias("_st"))
    st = st.select("g", F.col("_st.m").alias("mean"), F.col("_st.sd").alias("sd"))
    # One statistics row per fold: the table has k rows, broadcasting it is bounded.
    stb = F.broadcast(st)
    q = (train.withColumn("g", F.col(fold).cast("long")).join(stb, "g")
              .withColumn(vec, _standardise(F.col(vec), F.col("mean"), F.col("sd"))).drop("mean", "sd"))
    # Each reference row serves the k - 1 other folds: explode the bounded fold list.
    r = (train.withColumn("g", others).join(stb, "g")
              .withColumn(vec, _standardise(F.col(vec), F.col("mean"), F.col("sd"))).drop("mean", "sd"))
    return q, r


CACHED = 1 << 16         # entries of the distance matrix that are summed up at once


def _powers(Q: np.ndarray, R: np.ndarray, p: float) -> np.ndarray:
    """Sum of |q - r|^p of every pair, a dimension at a time, for as many queries as keep the sums in cache."""
    out = np.zeros((len(Q), len(R)), Q.dtype)
    columns = np.ascontiguousarray(R.T)
    step = max(1, CACHED // max(1, len(R)))
    diff = np.empty((min(step, len(Q)), len(R)), Q.dtype)
    for at in range(0, len(Q), step):
        part, sums = Q[at:at + step], out[at:at + step]
        d = diff[:len(part)]
        for j in range(Q.shape[1]):
            np.subtract(part[:, j, None], columns[j], out=d)
            sums += _power(d, p, d)
    return out


def _power(diff: np.ndarray, p: float, out: np.ndarray | None = None) -> np.ndarray:
    if p == 2:
        return np.multiply(diff, diff, out=out)
    diff = np.abs(diff, out=out)
    if p == 3:
        return np.multiply(diff * diff, diff, out=out)
    return diff if p == 1 else np.power(diff, p, out=out)


def _root(x: np.ndarray, p: float) -> np.ndarray:
    return x if p == 1 else np.sqrt(x) if p == 2 else np.power(x, 1.0 / p)


def _nearest(d: np.ndarray, rid: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k smallest of each row by (value, id): a partial selection, sorted at its end only."""
    k = min(k, d.shape[1])
    bound = np.partition(d, k - 1, axis=1)[:, k - 1]
    row, col = np.nonzero(d <= bound[:, None])
    order = np.lexsort((rid[col], d[row, col], row))
    row, col = row[order], col[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return row[place < k], col[place < k]


def _sides(pdf: pd.DataFrame):
    """Ids, vectors and labels of both sides of a tile; None if one is empty."""
    qs, rs = pdf[pdf["_side"] == 0], pdf[pdf["_side"] == 1]
    if qs.empty or rs.empty:
        return None
    return (qs["_id"].to_numpy(np.int64), np.vstack(qs["_vec"].to_numpy()).astype(np.float64),
            rs["_id"].to_numpy(np.int64), np.vstack(rs["_vec"].to_numpy()).astype(np.float64), rs["_label"].to_numpy())


def _tile_fn(k1: int, p: float):
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        sides = _sides(pdf)
        if sides is None:
            return pd.DataFrame({"g": [], "qid": [], "rid": [], "rlabel": [], "dist": []})
        qid, Q, rid, R, rlab = sides
        d = _root(_powers(Q, R, p), p)
        row, col = _nearest(d, rid, k1)
        return pd.DataFrame({"g": np.full(len(row), int(pdf["g"].iloc[0]), dtype=np.int64), "qid": qid[row],
                             "rid": rid[col], "rlabel": rlab[col].astype(str), "dist": d[row, col]})
    return fn


STRIP = 1 << 20          # distances that are held at once
REFS = 4096              # references that meet the queries at once
SINGLE = 1.2e-7          # twice the rounding error of a single-precision number


def _exactly(X: np.ndarray, R: np.ndarray, row: np.ndarray, col: np.ndarray, p: float) -> np.ndarray:
    """Distances of some pairs, their dimensions summed in the order of ``_powers``."""
    total = np.zeros(len(row))
    for j in range(X.shape[1]):
        total += _power(X[row, j] - R[col, j], p)
    return _root(total, p)


def _within(X: np.ndarray, R: np.ndarray, p: float, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, distance) of the pairs whose distance is at most the row's bound.

    For p = 2 a matrix product and for p = 1 single precision give the distances roughly; the pairs that
    their largest possible error leaves within the bound are then computed exactly."""
    top = max(np.abs(X).max(initial=0.0), np.abs(R).max(initial=0.0))
    rough = None
    if 1e-20 < top < 1e30 and np.isfinite(bound).all():
        d = X.shape[1]
        if p == 2:
            size = np.einsum("ij,ij->i", X, X)[:, None] + np.einsum("ij,ij->i", R, R)
            rough = size - 2 * (X @ R.T)
            limit = bound * bound * (1 + 1e-9) + 1e-14 * (d + 4) * size.max()
        elif p == 1:
            rough = _powers(X.astype(np.float32), R.astype(np.float32), 1)
            limit = bound * (1 + SINGLE * (d + 4)) + SINGLE * top * 2 * d
            limit = limit.astype(np.float32) * np.float32(1 + 1e-6)
    if rough is None:
        dist = _root(_powers(X, R, p), p)
        row, col = np.nonzero(dist <= bound[:, None])
        return row, col, dist[row, col]
    row, col = np.nonzero(rough <= limit[:, None])
    dist = _exactly(X, R, row, col, p)
    near = dist <= bound[row]
    return row[near], col[near], dist[near]


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


class _Kept:
    """The nearest references of every slot (a query, or one of its variants): those added, cut to the k first by (distance, id)."""

    def __init__(self, slots: int, k: int) -> None:
        self.k, self.kth, self.most = k, np.full(slots, np.inf), max(1 << 18, slots * k // 2)
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.new = 0

    def add(self, slot: np.ndarray, rid: np.ndarray, label: np.ndarray, dist: np.ndarray) -> None:
        self.parts.append((slot, rid, label, dist))
        self.new += len(slot)
        if self.new > self.most:
            self.cut()

    def cut(self) -> tuple[np.ndarray, ...]:
        slot, rid, label, dist = (np.concatenate(x) for x in zip(*self.parts)) if self.parts else (np.zeros(0, np.int64),) * 4
        order = np.lexsort((rid, dist, slot))
        slot, rid, label, dist = slot[order], rid[order], label[order], dist[order]
        place = np.arange(len(slot)) - np.searchsorted(slot, slot)
        last = place == self.k - 1
        self.kth[slot[last]] = dist[last]
        keep = place < self.k
        self.parts, self.new = [(slot[keep], rid[keep], label[keep], dist[keep])], 0
        return self.parts[0]


_NEAR = "array<struct<dist:double,rid:long,rlabel:string>>"


def _lists(keys: dict[str, pa.Array], slot: np.ndarray, rid: np.ndarray, label: pa.Array, dist: np.ndarray, slots: int) -> pa.RecordBatch:
    """One row a slot with its references as a list."""
    ends = np.searchsorted(slot, np.arange(slots + 1)).astype(np.int32)
    near = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(dist), pa.array(rid), label], ["dist", "rid", "rlabel"]))
    return pa.RecordBatch.from_arrays([*keys.values(), near], [*keys, "near"])


class _Labels:
    """Classes as numbers, null among them."""

    def __init__(self) -> None:
        self.names: list[str | None] = []
        self._at: dict[str | None, int] = {}

    def codes(self, column: pa.Array) -> np.ndarray:
        found = column.dictionary_encode()
        for name in [*found.dictionary.to_pylist(), None]:
            if name not in self._at:
                self._at[name] = len(self.names)
                self.names.append(name)
        table = np.array([self._at[x] for x in found.dictionary.to_pylist()] + [self._at[None]], np.int32)
        return table[found.indices.fill_null(len(table) - 1).to_numpy(zero_copy_only=False)]

    def of(self, codes: np.ndarray) -> pa.Array:
        return pa.array(self.names, pa.string()).take(pa.array(codes.astype(np.int32)))


class _Nearest:
    """A tile of a search: the k nearest references of each query for one or several distances."""

    def __init__(self, g: int, queries: pa.Table, ks: dict[float, int]) -> None:
        self.g, self.id, self.x = g, queries.column("_id").combine_chunks(), _matrix(queries.column("_vec").combine_chunks())
        self.labels, self.kept = _Labels(), {p: _Kept(len(self.x), k) for p, k in ks.items()}

    def add(self, rid: np.ndarray, R: np.ndarray, label: pa.Array) -> None:
        codes = self.labels.codes(label)
        step = max(1, STRIP // len(R))
        for p, kept in self.kept.items():
            for at in range(0, len(self.x), step):
                X, bound = self.x[at:at + step], kept.kth[at:at + step]
                if np.isfinite(bound).all():
                    row, col, dist = _within(X, R, p, bound)
                else:
                    d = _root(_powers(X, R, p), p)
                    d[np.isnan(d)] = np.inf
                    row, col = _nearest(d, rid, kept.k)
                    dist = d[row, col]
                    some = np.isfinite(dist)
                    row, col, dist = row[some], col[some], dist[some]
                kept.parts.append((row + at, rid[col], codes[col], dist))
                kept.new += len(row)
            if kept.new > kept.most or not np.isfinite(kept.kth).all():
                kept.cut()

    def rows(self) -> Iterator[pa.RecordBatch]:
        n = len(self.x)
        for p, kept in self.kept.items():
            slot, rid, code, dist = kept.cut()
            keys = {"g": pa.array(np.full(n, self.g, np.int64)), "p": pa.array(np.full(n, float(p))), "qid": self.id}
            yield _lists(keys, slot, rid, self.labels.of(code), dist, n)


class _Permuted:
    """A tile of the permutation importance: a query's vector stands between a bound on the distance to its k-th
    reference and its ``dims * reps`` replaced values.

    A replacement that moves a query by delta moves every distance by delta at most (triangle inequality). So the k
    nearest of a variant are within the bound and delta, and before the move they were within twice delta; only
    such pairs are looked at, and only the changed dimension's share of their distance is computed anew."""

    def __init__(self, g: int, queries: pa.Table, k: int, p: float, dims: int, reps: int) -> None:
        self.id, all_ = queries.column("_id").combine_chunks(), _matrix(queries.column("_vec").combine_chunks())
        self.x, self.changed, self.p = all_[:, 1:1 + dims], all_[:, 1 + dims:1 + dims + dims * reps], p
        self.of = np.repeat(np.arange(dims), reps)
        self.labels, self.kept = _Labels(), _Kept(len(all_) * dims * reps, k)
        delta = np.abs(self.changed - self.x[:, self.of]) if p >= 1 else np.full(self.changed.shape, np.inf)
        far = np.where(np.isnan(delta), np.inf, delta)
        bound = all_[:, :1] + far
        ids, same = np.unique(self.id.to_numpy(zero_copy_only=False), return_inverse=True)
        if len(ids) < len(same):
            most = np.full((len(ids), bound.shape[1]), -np.inf)
            np.maximum.at(most, same, bound)
            bound = most[same]
        slack = 1e-9 * (1 + np.abs(bound))
        self.bound = bound + slack
        self.reach = (self.bound + far).max(axis=1) * (1 + 1e-9)

    def add(self, rid: np.ndarray, R: np.ndarray, label: pa.Array) -> None:
        codes, p, wide = self.labels.codes(label), self.p, self.changed.shape[1]
        step = max(1, STRIP // len(R))
        for at in range(0, len(self.x), step):
            X = self.x[at:at + step]
            rows, cols, dists = _within(X, R, p, self.reach[at:at + step])
            for i in range(0, len(rows), max(1, STRIP // wide)):
                row, col, dist = (v[i:i + max(1, STRIP // wide)] for v in (rows, cols, dists))
                base = _power(dist.copy(), p) if p != 1 else dist
                old = _power(X[row] - R[col], p)
                new = _power(self.changed[row + at] - R[col][:, self.of], p)
                d = _root(np.maximum((base[:, None] - old)[:, self.of] + new, 0.0), p)
                pair, v = np.nonzero(d <= self.bound[row + at])
                self.kept.add((row[pair] + at) * wide + v, rid[col[pair]], codes[col[pair]], d[pair, v])

    def rows(self) -> Iterator[pa.RecordBatch]:
        n, wide = self.changed.shape
        slot, rid, code, dist = self.kept.cut()
        step = max(1, STRIP // 16 // wide)
        for at in range(0, n, step):
            part = slice(*np.searchsorted(slot, [at * wide, min(n, at + step) * wide]))
            m = min(n, at + step) - at
            keys = {"qid": self.id.slice(at, m).take(pa.array(np.repeat(np.arange(m), wide))),
                    "variant": pa.array(np.tile(np.arange(wide, dtype=np.int32), m))}
            yield _lists(keys, slot[part] - at * wide, rid[part], self.labels.of(code[part]), dist[part], m * wide)


def _streamed(make):
    """Tiles from rows sorted by tile and side: queries are held, references stream past them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, job = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            marks = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("g", "qb", "rb", "_side")])
            starts = np.flatnonzero(np.append(True, (marks[:, 1:] != marks[:, :-1]).any(0)))
            for at, to in zip(starts, [*starts[1:], batch.num_rows]):
                if key != tuple(marks[:3, at]):
                    if job is not None:
                        yield from job.rows()
                    key, held, job = tuple(marks[:3, at]), [], None
                part = batch.slice(at, to - at)
                if marks[3, at] == 0:
                    held.append(part)
                elif held:
                    job = job or make(int(marks[0, at]), pa.Table.from_batches(held))
                    ids, x, label = part.column("_id").to_numpy(zero_copy_only=False), _matrix(part.column("_vec")), part.column("_label")
                    for i in range(0, len(ids), REFS):
                        job.add(ids[i:i + REFS], x[i:i + REFS], label.slice(i, REFS))
        if job is not None:
            yield from job.rows()

    return run


QUERIES = 16384          # most queries of a tile
TIMES = 16               # a tile streams at most this many references a query
MOST_TASKS = 4096


def search_tiles(left: DataFrame, right: DataFrame, make, schema: str, *, id_col: str, vec: str, label: str,
                 group: str | None = None, block: int = QUERIES, most_refs: int | None = None) -> DataFrame:
    """Run ``make(g, queries)`` jobs on every (query block, reference block) pair of a group.

    There are at least two tiles a core, cut so that few rows are copied (a query goes to every reference block, a
    reference to every query block); a query block has about ``block`` rows at most and a reference block
    ``most_refs``, so what a task reads is bounded."""
    def most(d: DataFrame) -> tuple[int, int]:
        if not group:
            return d.count(), 1
        r = d.groupBy(group).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n"), F.count(F.lit(1))).head()
        return r[0] or 0, max(1, r[1])

    (nl, groups), (nr, _) = most(left), most(right)
    tiles = math.ceil(2 * left.sparkSession.sparkContext.defaultParallelism / groups)
    lb = max(1, min(nl, max(math.ceil(nl / block), math.ceil(math.sqrt(tiles * nl / max(nr, 1))))))
    rb = max(1, min(nr, max(math.ceil(nr / (most_refs or block * TIMES)), math.ceil(tiles / lb))))
    g = F.col(group).cast("long") if group else F.lit(0).cast("long")
    sides = []
    for d, side, own, other, n, m in ((left, 0, "qb", "rb", lb, rb), (right, 1, "rb", "qb", rb, lb)):
        lab = F.col(label) if side and label in d.columns else F.lit(None)
        rows = d.select(g.alias("g"), F.col(id_col).cast("long").alias("_id"), F.col(vec).alias("_vec"), lab.cast("string").alias("_label"),
                        F.lit(side).alias("_side"), F.pmod(F.xxhash64(id_col), F.lit(n).cast("long")).alias(own),
                        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(m - 1).cast("long"))).alias(other))
        sides.append(rows.select("g", "qb", "rb", "_side", "_id", "_vec", "_label"))
    dealt = sides[0].unionByName(sides[1]).repartition(min(MOST_TASKS, 2 * lb * rb * groups), "g", "qb", "rb")
    return dealt.sortWithinPartitions("g", "qb", "rb", "_side").mapInArrow(_streamed(make), schema)


def _merged(tiles: DataFrame, keys: Sequence[str], k: Column) -> DataFrame:
    """The lists of all tiles as one list a key, of the first k by (distance, id)."""
    near = F.slice(F.sort_array(F.flatten(F.collect_list("near"))), F.lit(1), k)
    return tiles.groupBy(*keys).agg(near.alias("near"))


def _ranked(lists: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row a neighbour, with its rank from 1."""
    return lists.select(*keys, F.posexplode("near").alias("rn", "n")).select(*keys, F.col("n.rid").alias("rid"), F.col("n.rlabel").alias("rlabel"),
                                                                            F.col("n.dist").alias("dist"), (F.col("rn") + 1).alias("rn"))


def block_tiles(rows: DataFrame, fn, schema: str, *, id_col: str = "id", vec: str = "vec", label: str = "label",
                block: int = QUERIES) -> DataFrame:
    """Run ``fn(pandas tile) -> pandas`` on every pair of blocks of ``rows``, each once (``qb`` <= ``rb``).

    Rows are hashed into blocks of about ``block`` rows at most; a tile holds one block on each side (column
    ``_side`` 0 / 1), so a task never holds more than two blocks."""
    n = rows.count()
    # At least ~2 tiles per core even for small inputs; block-sized tiles at scale.
    side = math.ceil(math.sqrt(4 * rows.sparkSession.sparkContext.defaultParallelism))
    blocks = max(1, min(max(side, math.ceil(n / block)), n))
    own = F.pmod(F.xxhash64(id_col), F.lit(blocks).cast("long"))
    x = rows.select(F.lit(0).cast("long").alias("g"), F.col(id_col).cast("long").alias("_id"), F.col(vec).alias("_vec"),
                    F.col(label).cast("string").alias("_label"), own.alias("_own"))
    first = x.select("g", "_id", "_vec", "_label", F.lit(0).alias("_side"), F.col("_own").alias("qb"),
                     F.explode(F.sequence(F.col("_own"), F.lit(blocks - 1).cast("long"))).alias("rb"))
    second = x.select("g", "_id", "_vec", "_label", F.lit(1).alias("_side"),
                      F.explode(F.sequence(F.lit(0).cast("long"), F.col("_own"))).alias("qb"), F.col("_own").alias("rb"))
    # A tile is one task's work: more shuffle partitions than tiles, whatever their size.
    tiles = first.unionByName(second).repartition(min(MOST_TASKS, blocks * (blocks + 1)), "g", "qb", "rb")
    return tiles.groupBy("g", "qb", "rb").applyInPandas(fn, schema)


def neighbours(queries: DataFrame, refs: DataFrame, k: int, p: float = 2, *, id_col: str = "id",
               vec: str = "vec", label: str = "label", group: str | None = None,
               block: int | None = None) -> DataFrame:
    """The k nearest references of every query (within ``group`` if given),
    with rank ``rn`` 1..k by (distance, reference id)."""
    tiles = search_tiles(queries, refs, partial(_Nearest, ks={p: k}), f"g long, p double, qid long, near {_NEAR}", id_col=id_col, vec=vec,
                         label=label, group=group, block=block or QUERIES)
    return _ranked(_merged(tiles, ["g", "qid"], F.lit(k)), ["g", "qid"])


MOST_PIVOTS = 1024


@dataclass
class Cells:
    """Pivots (m x d) and, of the references nearest to each, how many there are and the largest distance to it."""

    pivot: np.ndarray
    count: np.ndarray
    radius: np.ndarray

    def distances(self, x: np.ndarray, p: float) -> np.ndarray:
        return _root(_powers(x, self.pivot, p), p)

    def reach(self, d: np.ndarray, k: int) -> np.ndarray:
        """For each row of distances to the pivots a bound on the distance to the k-th nearest reference: the
        nearest cells, by the distance to their farthest member, that hold k references together."""
        far = np.where(self.count > 0, d + self.radius, np.inf)
        order = np.argsort(far, axis=1, kind="stable")
        enough = np.argmax(np.cumsum(self.count[order], axis=1) >= k, axis=1)
        bound = np.take_along_axis(far, np.take_along_axis(order, enough[:, None], 1), 1)[:, 0]
        return np.where(self.count.sum() >= k, bound, np.inf)

    def visits(self, d: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Which cells can hold a reference within the bound of each row (triangle inequality)."""
        slack = 1e-9 * (1 + np.abs(d) + self.radius)
        return (self.count > 0) & (d - self.radius <= bound[:, None] + slack)


def cells_of(refs: DataFrame, p: float, *, id_col: str = "id", vec: str = "vec", block: int = 1024,
             pivots: int | None = None) -> tuple[Cells, DataFrame]:
    """Pivots, at most ``MOST_PIVOTS`` references by a hash of their id, and ``refs`` with the number of their cell in ``cell``."""
    m = pivots or min(MOST_PIVOTS, max(1, math.ceil(refs.count() / block)))
    some = refs.orderBy(F.xxhash64(id_col), id_col).select(vec).limit(m).collect()
    pivot = np.array([r[0] for r in some], np.float64)
    blank = Cells(pivot, np.zeros(len(pivot)), np.zeros(len(pivot)))

    def nearest(batches):
        for batch in batches:
            x = np.stack(batch.column(vec).to_numpy(zero_copy_only=False)) if batch.num_rows else np.zeros((0, pivot.shape[1]))
            d = blank.distances(x, p)
            at = d.argmin(axis=1) if len(x) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at.astype(np.int32)), pa.array(d[np.arange(len(x)), at])],
                                             [*batch.schema.names, "cell", "_away"])

    schema = refs.select("*", F.lit(0).alias("cell"), F.lit(0.0).alias("_away")).schema
    placed = materialise(refs.mapInArrow(nearest, schema))
    for r in placed.groupBy("cell").agg(F.count("*"), F.max("_away")).collect():
        blank.count[r[0]], blank.radius[r[0]] = r[1], r[2]
    return blank, placed.drop("_away")


def visited(queries: DataFrame, cells: Cells, k: int, p: float, *, id_col: str = "id", vec: str = "vec",
            bound: str | None = None) -> DataFrame:
    """``queries`` with an array ``cells`` of the cells that can hold one of the k nearest references, the nearest
    pivot's cell in ``home`` and their bound; ``bound`` names a column with a smaller bound, if known."""
    def found(batches):
        for batch in batches:
            x = np.stack(batch.column(vec).to_numpy(zero_copy_only=False)) if batch.num_rows else np.zeros((0, cells.pivot.shape[1]))
            d = cells.distances(x, p)
            reach = cells.reach(d, k) if len(x) else np.zeros(0)
            if bound:
                reach = np.minimum(reach, np.nan_to_num(batch.column(bound).to_numpy(zero_copy_only=False).astype(float), nan=np.inf))
            hit = cells.visits(d, reach)
            home = np.where(cells.count > 0, d, np.inf).argmin(axis=1) if len(x) else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(hit.sum(axis=1))]).astype(np.int32)),
                                             pa.array(np.nonzero(hit)[1].astype(np.int32)))
            keep = [c for c in batch.schema.names if c != bound]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [lists, pa.array(home.astype(np.int32)), pa.array(reach)],
                                             [*keep, "cells", "home", "reach"])

    keep = queries.drop(bound) if bound else queries
    schema = keep.select("*", F.array(F.lit(0)).alias("cells"), F.lit(0).alias("home"), F.lit(0.0).alias("reach")).schema
    return queries.mapInArrow(found, schema)


def _cell_tiles(queries: DataFrame, refs: DataFrame, fn, schema: str, id_col: str, vec: str, label: str | None, block: int) -> DataFrame:
    """Run ``fn`` on tiles of the queries and the references of each cell; cells of many rows have many tiles."""
    sizes = (queries.groupBy("cell").agg(F.count("*").alias("nq")).join(refs.groupBy("cell").agg(F.count("*").alias("nr")), "cell")
             .select("cell", F.ceil(F.col("nq") / block).alias("lb"), F.ceil(F.col("nr") / block).alias("rb")))
    # One row a cell, MOST_PIVOTS at most.
    few = F.broadcast(sizes)
    lab = lambda d: F.col(label).cast("string") if label and label in d.columns else F.lit(None).cast("string")
    sides = []
    for d, side, own, other in ((queries, 0, "qb", "rb"), (refs, 1, "rb", "qb")):
        many = {"qb": F.col("lb"), "rb": F.col("rb")}
        rows = d.join(few, "cell").select(
            F.lit(0).cast("long").alias("g"), "cell", F.col(id_col).cast("long").alias("_id"), F.col(vec).alias("_vec"), lab(d).alias("_label"),
            F.lit(side).alias("_side"), F.pmod(F.xxhash64(id_col), many[own]).alias(own),
            F.explode(F.sequence(F.lit(0).cast("long"), many[other] - 1)).alias(other))
        sides.append(rows.select("g", "cell", "_id", "_vec", "_label", "_side", "qb", "rb"))
    return sides[0].unionByName(sides[1]).groupBy("cell", "qb", "rb").applyInPandas(fn, schema)


def pivot_neighbours(queries: DataFrame, refs: DataFrame, k: int, p: float = 2, *, id_col: str = "id", vec: str = "vec",
                     label: str = "label", block: int = 1024, pivots: int | None = None) -> DataFrame:
    """As ``neighbours`` (exact, same ties), but a query only meets the cells that can hold one of its k nearest.

    References belong to the cell of their nearest pivot. A query is searched in its own cell first; the
    distance to its k-th there, or the bound from the cells' radii if that is smaller, rules out every cell
    whose pivot is farther than that bound and the cell's radius together. It is then copied into the others."""
    cells, placed = cells_of(refs, p, id_col=id_col, vec=vec, block=block, pivots=pivots)
    asked = materialise(visited(queries.select(id_col, vec), cells, k, p, id_col=id_col, vec=vec))
    own = asked.select(id_col, vec, F.col("home").alias("cell"))
    first = materialise(_cell_tiles(own, placed, _tile_fn(k, p), _NEIGHBOUR_SCHEMA, id_col, vec, label, block))
    w = Window.partitionBy("g", "qid").orderBy("dist", "rid")
    kth = (first.withColumn("rn", F.row_number().over(w)).where(F.col("rn") == k).select(F.col("qid").alias(id_col), F.col("dist").alias("_kth")))
    nearer = visited(asked.select(id_col, vec, "home").join(kth, id_col, "left").withColumnRenamed("home", "_home"), cells, k, p,
                     id_col=id_col, vec=vec, bound="_kth")
    rest = (nearer.select(id_col, vec, "_home", F.explode("cells").alias("cell")).where(F.col("cell") != F.col("_home")).drop("_home"))
    more = _cell_tiles(rest, placed, _tile_fn(k, p), _NEIGHBOUR_SCHEMA, id_col, vec, label, block)
    return first.unionByName(more).withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k)


def kernel_weight(kernel: str, dist: Column, d_next: Column, k: Column) -> Column:
    """Vote weight of a neighbour from d / d(k+1), clipped to (1e-6, 1 - 1e-6)."""
    u = F.least(F.greatest(F.coalesce(F.try_divide(dist, d_next), F.lit(0.0)), F.lit(1e-6)), F.lit(1 - 1e-6))
    if kernel == "rectangular":
        return F.lit(1.0)
    if kernel == "triangular":
        return 1 - u
    if kernel == "inv":
        return 1 / u
    if kernel == "gaussian":
        # Normal density of u * |q(1 / (2 (k + 1)))|.
        from fieldstat.functions.columns import normal_quantile_sql
        z = F.abs(F.expr(normal_quantile_sql("(CAST(1 AS DOUBLE) / (2 * (_k + 1)))")))
        x = u * z
        return F.exp(-x * x / 2) / math.sqrt(2 * math.pi)
    raise ValueError(f"unknown kernel {kernel}")


def vote(nb: DataFrame, k: int, kernel: str, levels: Sequence[str] | None = None,
         keys: Sequence[str] = ("g", "qid")) -> DataFrame:
    """Weighted vote of the k nearest (``nb`` holds k+1 ranked neighbours).
    Returns keys, prediction, and per-class vote shares ``proba`` (map class -> share).
    Ties in the vote go to the first class level (or the smallest label)."""
    keys = list(keys)
    w = Window.partitionBy(*keys)
    x = nb.withColumn("_dnext", F.max(F.when(F.col("rn") == k + 1, F.col("dist"))).over(w))
    x = x.withColumn("_dnext", F.coalesce("_dnext", F.max("dist").over(w))).where(F.col("rn") <= k)
    x = x.withColumn("_k", F.lit(k)).withColumn("_w", kernel_weight(kernel, F.col("dist"), F.col("_dnext"), F.col("_k")))
    per = x.groupBy(*keys, "rlabel").agg(F.sum("_w").alias("score"))
    order = (F.array_position(F.array(*[F.lit(l) for l in levels]), F.col("rlabel"))
             if levels else F.lit(0))
    best = per.groupBy(*keys).agg(
        F.min(F.struct((-F.col("score")).alias("neg"), order.alias("o"), F.col("rlabel").alias("c"))).alias("_b"),
        F.sum("score").alias("_tot"),
        F.map_from_entries(F.collect_list(F.struct("rlabel", "score"))).alias("_scores"))
    return best.select(*keys, F.col("_b.c").alias("prediction"),
                       F.transform_values("_scores", lambda _, v: v / F.col("_tot")).alias("proba"))


def knn_predict(train: DataFrame, test: DataFrame, k: int, p: float = 2, kernel: str = "rectangular",
                *, id_col: str = "id", vec: str = "vec", label: str = "label",
                levels: Sequence[str] | None = None, scale: bool = True, block: int | None = None,
                pivots: int | None = None) -> DataFrame:
    """Standardise both sides with train statistics (K3), find k+1 neighbours (by cells of ``pivots``
    references, if given; for data with clusters), vote. Returns test rows' id, true label, prediction and vote shares."""
    tr = scale_with(train, train, vec) if scale else train
    te = scale_with(train, test, vec) if scale else test
    find = partial(pivot_neighbours, pivots=pivots) if pivots else neighbours
    sizes = {"block": block} if block else {}
    nb = find(te, tr, k + 1, p, id_col=id_col, vec=vec, label=label, **sizes)
    v = vote(nb, k, kernel, levels)
    return (test.select(F.col(id_col).cast("long").alias("qid"), F.col(label).cast("string").alias("label"))
                .join(v.drop("g"), "qid"))


def weighted_f1_by(pred: DataFrame, keys: Sequence[str], label: str = "label",
                   prediction: str = "prediction") -> DataFrame:
    """M5 per group of rows: Σ_c (true share of c) · F1_c, undefined F1 -> 0."""
    keys = list(keys)
    t = pred.groupBy(*keys, F.col(label).alias("c")).agg(F.count(F.lit(1)).alias("n_true"))
    pp = pred.groupBy(*keys, F.col(prediction).alias("c")).agg(F.count(F.lit(1)).alias("n_pred"))
    tp = (pred.where(F.col(label) == F.col(prediction)).groupBy(*keys, F.col(label).alias("c"))
              .agg(F.count(F.lit(1)).alias("tp")))
    j = t.join(pp, [*keys, "c"], "full").join(tp, [*keys, "c"], "left").na.fill(0, ["n_true", "n_pred", "tp"])
    f1 = F.when(F.col("n_true") + F.col("n_pred") > 0, 2 * F.col("tp") / (F.col("n_true") + F.col("n_pred")))
    f1 = F.coalesce(f1, F.lit(0.0))
    return j.groupBy(*keys).agg((F.sum(F.col("n_true") * f1) / F.sum("n_true")).alias("f1"))


def _grid_weight(dist: Column, d_next: Column) -> Column:
    """L12 with the kernel taken from the row's ``kernel`` column (k from ``_k``)."""
    kern = F.col("kernel")
    out = None
    for name in KERNELS:
        w = kernel_weight(name, dist, d_next, F.col("_k"))
        out = F.when(kern == name, w) if out is None else out.when(kern == name, w)
    return out


def knn_grid(train: DataFrame, grid: DataFrame, folds: int = 10, fold_col: str = "fold", *,
             id_col: str = "id", vec: str = "vec", label: str = "label",
             levels: Sequence[str] | None = None, block: int | None = None, digits: int = 4) -> DataFrame:
    """Stratified-fold cross-validation of a (k, distance, kernel) grid.

    Neighbours up to max k + 1 are found in one search for all distances and folds (the
    fold is the tile group), a list for each (distance, query); every grid row takes the
    head of its list, and one aggregate scores every (grid row, fold) at once.
    Returns the grid with mean, sd and se of the weighted F1 over folds."""
    rows = grid.select("k", "distance", "kernel").distinct().orderBy("distance", "k", "kernel").collect()
    q, r = fold_scaled(train, fold_col, vec)
    truth = q.select("g", F.col(id_col).cast("long").alias("qid"), F.col(label).cast("string").alias("label"))
    order = (F.array_position(F.array(*[F.lit(l) for l in levels]), F.col("rlabel")) if levels else F.lit(0))
    ks = {float(x.distance): max(y.k for y in rows if y.distance == x.distance) + 1 for x in rows}
    tiles = search_tiles(q, r, partial(_Nearest, ks=ks), f"g long, p double, qid long, near {_NEAR}", id_col=id_col, vec=vec, label=label,
                         group="g", block=block or QUERIES)
    most = F.element_at(F.create_map(*[F.lit(v) for item in ks.items() for v in item]), F.col("p"))
    lists = _merged(tiles, ["p", "g", "qid"], F.first(most))
    gl = F.array(*[F.struct(F.lit(i).alias("gid"), F.lit(float(x.distance)).alias("_p"), F.lit(int(x.k)).alias("_k"), F.lit(x.kernel).alias("kernel"))
                   for i, x in enumerate(rows)])                      # the grid: bounded
    # ``p`` stays among the keys, so that the rows of the lists are grouped where they are.
    x = lists.withColumn("gr", F.explode(F.filter(gl, lambda e: e["_p"] == F.col("p")))).select("p", "g", "qid", "near", "gr.gid", "gr._k", "gr.kernel")
    following = F.coalesce(F.get("near", F.col("_k"))["dist"], F.element_at("near", -1)["dist"])
    x = x.where(F.size("near") > 0).select("p", "g", "qid", "gid", "_k", "kernel", following.alias("_dnext"),
                                           F.explode(F.slice("near", F.lit(1), F.col("_k"))).alias("n"))
    x = x.select("p", "g", "qid", "gid", F.col("n.rlabel").alias("rlabel"), _grid_weight(F.col("n.dist"), F.col("_dnext")).alias("_w"))
    per = x.groupBy("p", "gid", "g", "qid", "rlabel").agg(F.sum("_w").alias("score"))
    best = per.groupBy("p", "gid", "g", "qid").agg(
        F.min(F.struct((-F.col("score")).alias("neg"), order.alias("o"), F.col("rlabel").alias("c"))).alias("_b"))
    pred = best.select("gid", "g", "qid", F.col("_b.c").alias("prediction")).join(truth, ["g", "qid"])
    f = weighted_f1_by(pred, ["gid", "g"])
    meta = train.sparkSession.createDataFrame([(i, int(x.k), float(x.distance), x.kernel) for i, x in enumerate(rows)],
                                              "gid int, k int, distance double, kernel string")
    allf = f.join(F.broadcast(meta), "gid")
    return (allf.groupBy("k", "distance", "kernel")
                .agg(F.round(F.avg("f1"), digits).alias("f1"), F.round(F.stddev_samp("f1"), digits).alias("f1_sd"),
                     F.round(F.stddev_samp("f1") / F.sqrt(F.count("f1")), digits).alias("f1_se"))
                .orderBy(F.desc("f1"), "k", "distance", "kernel"))


def scenario_tables(grid: DataFrame, scenarios: DataFrame, digits: int = 4) -> DataFrame:
    """L5 for a searched grid: the rows of every scenario (scenario, k, distance, kernel; bounded lists of
    settings) with the scenario's best one flagged (ties: smallest k, distance, kernel) and the spread of its F1."""
    w = Window.partitionBy("scenario")
    place = F.row_number().over(w.orderBy(F.desc("f1"), "k", "distance", "kernel"))
    rows = grid.join(F.broadcast(scenarios), ["k", "distance", "kernel"])
    return rows.select("scenario", "k", "distance", "kernel", "f1", "f1_sd", (place == 1).alias("best"),
                       F.round(F.max("f1").over(w) - F.min("f1").over(w), digits).alias("spread"))


def permuted_values(test: DataFrame, features: int, reps: int, seed: int = 42, *,
                    id_col: str = "id", vec: str = "vec") -> DataFrame:
    """L15 helper: (id, changed): for every (feature j, repetition), in this order, the value
    of dimension j that the row takes in the shuffle: that of the row at the same
    position of a second seeded order. Only ids and single values are ranked."""
    from fieldstat.operators.ranking import running_total
    values = F.flatten(F.transform(F.slice(F.col(vec), 1, features), lambda x: F.array_repeat(x, reps)))
    x = test.select(F.col(id_col).alias("_row"), F.posexplode(values).alias("variant", "_x"))
    def order(s: int) -> Column:
        return F.md5(F.concat_ws(":", F.lit(str(s)), F.col("variant").cast("string"), F.col("_row").cast("string")))

    a = running_total(x.withColumn("_k", order(seed)), ["_k", "_row"], ["variant"], out="_pos")
    b = running_total(x.withColumn("_k", order(seed + 1)), ["_k", "_row"], ["variant"], out="_pos")
    j = a.select("variant", "_pos", "_row").join(b.select("variant", "_pos", "_x"), ["variant", "_pos"])
    # features x reps values of a row: bounded by parameters.
    g = j.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("variant", "_x"))).alias("_c"))
    return g.select(F.col("_row").alias(id_col), F.col("_c._x").alias("changed"))


def permutation_importance(train: DataFrame, test: DataFrame, names: Sequence[str], k: int,
                           p: float = 2, kernel: str = "rectangular", reps: int = 5, seed: int = 42, *,
                           id_col: str = "id", vec: str = "vec", label: str = "label",
                           levels: Sequence[str] | None = None, block: int = 512,
                           digits: int = 4) -> DataFrame:
    """Mean drop of weighted F1 over ``reps`` shuffles of each test column; also
    clipped at 0 and normalised to sum 1 (NULL where no feature matters). Ids may be any
    whole numbers, each once."""
    dims = len(names)
    tr = scale_with(train, train, vec)
    te = scale_with(train, test, vec)
    truth = test.select(F.col(id_col).cast("long").alias("qid"), F.col(label).cast("string").alias("label"))
    base_nb = materialise(neighbours(te, tr, k + 1, p, id_col=id_col, vec=vec, label=label))
    base = weighted_f1_by(vote(base_nb, k, kernel, levels).join(truth, "qid"), []).select(F.col("f1").alias("base"))
    # The distance to the (k + 1)-th bounds what a variant has to look at; without so many references nothing does.
    kth = base_nb.where(F.col("rn") == k + 1).groupBy(F.col("qid").alias("_qid")).agg(F.max("dist").alias("_kth"))
    both = te.join(permuted_values(te, dims, reps, seed, id_col=id_col, vec=vec), id_col)
    both = both.join(kth, F.col(id_col).cast("long") == F.col("_qid"), "left")
    packed = F.concat(F.array(F.coalesce("_kth", F.lit(float("inf")))), F.col(vec), F.col("changed"))
    tiles = search_tiles(both.select(id_col, packed.alias(vec)), tr, partial(_Permuted, k=k + 1, p=p, dims=dims, reps=reps),
                         f"qid long, variant int, near {_NEAR}", id_col=id_col, vec=vec, label=label, block=block, most_refs=QUERIES * TIMES)
    nb = _ranked(_merged(tiles, ["variant", "qid"], F.lit(k + 1)), ["variant", "qid"])
    v = vote(nb, k, kernel, levels, keys=("variant", "qid"))
    f = weighted_f1_by(v.join(truth, "qid"), ["variant"])
    f = f.withColumn("base", base.select("base").scalar())
    drops = (f.withColumn("feature", F.floor(F.col("variant") / F.lit(reps)).cast("int"))
              .groupBy("feature").agg(F.avg(F.col("base") - F.col("f1")).alias("drop")))
    names_df = train.sparkSession.createDataFrame(list(enumerate(names)), "feature int, name string")
    out = drops.join(F.broadcast(names_df), "feature")
    tot = out.select(F.sum(F.greatest(F.col("drop"), F.lit(0.0)))).scalar()
    return (out.select(F.col("name").alias("feature"), F.round("drop", digits).alias("importance"),
                       F.round(F.try_divide(F.greatest(F.col("drop"), F.lit(0.0)), tot), digits).alias("importance_norm"))
               .orderBy(F.desc("importance"), "feature"))
