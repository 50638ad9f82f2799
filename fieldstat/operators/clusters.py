"""Cluster quality, agreement and profiles.

Inputs are rows with an id, a feature array ``vec`` (array<double>), a cluster
and optionally a class. Sums of squares come from per-(cluster, dimension)
aggregates; the squared-Euclidean silhouette has a closed form over the k
cluster summaries; only the plain-Euclidean silhouette needs pair sums, which
run as block tiles (numpy inside tasks, no pair rows).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldstat.operators.knn import QUERIES, STRIP, _powers, _sides, block_tiles


def _dim_sums(df: DataFrame, cluster: str, vec: str) -> DataFrame:
    ex = df.select(F.col(cluster).alias("c"), F.posexplode(vec).alias("pos", "x"))
    return ex.groupBy("c", "pos").agg(F.count("x").alias("n"), F.var_samp("x").alias("v"))


def sse(df: DataFrame, cluster: str = "cluster", vec: str = "vec", digits: int | None = 4) -> DataFrame:
    """SSE = Σ over (cluster, dim) of (n - 1)·var_samp, and W = 2·SSE."""
    d = _dim_sums(df, cluster, vec)
    out = d.agg(F.sum((F.col("n") - 1) * F.coalesce("v", F.lit(0.0))).alias("SSE"))
    out = out.withColumn("W", 2 * F.col("SSE"))
    return out.select(*[F.round(c, digits).alias(c) for c in ("SSE", "W")]) if digits is not None else out


def w_pairs(df: DataFrame, cluster: str = "cluster", vec: str = "vec", digits: int | None = 4) -> DataFrame:
    """W from all within-cluster pairs, sum over c of (2 / n_c) times the sum over its pairs of
    |x_i - x_j|^2. That sum is n sum |y|^2 - |sum y|^2 of the cluster for any common shift y of the rows (here
    by the mean of all rows, so that large means do not cancel); no pair is formed, and unlike N4 no mean or
    variance of a cluster is, so the two check each other."""
    ex = centred(df, vec).select(F.col(cluster).alias("c"), F.posexplode(vec).alias("pos", "y"))
    d = ex.groupBy("c", "pos").agg(F.count("y").alias("n"), F.sum("y").alias("s1"), F.sum(F.col("y") * F.col("y")).alias("s2"))
    per = d.groupBy("c").agg(F.max("n").alias("n"), F.sum(F.col("n") * F.col("s2") - F.col("s1") * F.col("s1")).alias("pairs"))
    out = per.agg(F.sum(2 * F.col("pairs") / F.col("n")).alias("W_pairs"))
    return out.select(F.round("W_pairs", digits).alias("W_pairs")) if digits is not None else out


def centred(df: DataFrame, vec: str = "vec") -> DataFrame:
    """``vec`` less its overall mean: distances stay, and squares of large means do not cancel."""
    m = (df.select(F.posexplode(vec).alias("pos", "x")).groupBy("pos").agg(F.avg("x").alias("m"))
           .agg(F.sort_array(F.collect_list(F.struct("pos", "m"))).alias("a")).select("a.m").head())
    mean = F.array(*[F.lit(float(x)) for x in (m[0] or [])]) if m else F.array()
    return df.withColumn(vec, F.zip_with(vec, mean, lambda x, c: x - c))


def _cluster_summary(df: DataFrame, cluster: str, vec: str) -> Column:
    """Literal array of (cluster, n, Σ||x||², Σx) over the k clusters: k x d numbers,
    bounded by the model size, read once from a two-level aggregate."""
    ex = df.select(F.col(cluster).alias("c"), F.posexplode(vec).alias("pos", "x"))
    per_dim = ex.groupBy("c", "pos").agg(F.sum("x").alias("s1"), F.sum(F.col("x") * F.col("x")).alias("s2"))
    per_c = per_dim.groupBy("c").agg(
        F.sort_array(F.collect_list(F.struct("pos", "s1"))).alias("_s"), F.sum("s2").alias("y"))
    n = df.groupBy(F.col(cluster).alias("c")).agg(F.count(F.lit(1)).alias("n"))
    rows = per_c.join(n, "c").select("c", "n", "y", F.col("_s.s1").alias("s")).collect()
    return F.array(*[F.struct(F.lit(r["c"]).cast("string").alias("c"), F.lit(int(r["n"])).cast("long").alias("n"),
                              F.lit(float(r["y"])).alias("y"),
                              F.array(*[F.lit(float(v)) for v in r["s"]]).alias("s")) for r in rows])


def silhouette_sq_rows(df: DataFrame, cluster: str = "cluster", vec: str = "vec",
                       id_col: str = "id") -> DataFrame:
    """N6/N7 (squared Euclidean, as Spark's ClusteringEvaluator): per row
    D(i, C) = ||x_i||² - 2 x_i·Σx_C / n_C + Σ||x||²_C / n_C; a(i) uses n/(n-1)."""
    df = centred(df, vec)
    summ = _cluster_summary(df, cluster, vec)
    xi2 = F.aggregate(F.col(vec), F.lit(0.0), lambda a, x: a + x * x)
    def dot(s):
        return F.aggregate(F.zip_with(F.col(vec), s, lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    dists = F.transform(summ, lambda st: F.struct(
        st["c"].alias("c"), st["n"].alias("n"),
        (xi2 - 2 * dot(st["s"]) / st["n"] + st["y"] / st["n"]).alias("d")))
    x = df.select(F.col(id_col), F.col(cluster), dists.alias("_d"))
    own = F.get(F.filter("_d", lambda e: e["c"] == F.col(cluster).cast("string")), 0)
    others = F.filter("_d", lambda e: e["c"] != F.col(cluster).cast("string"))
    a = own["d"] * own["n"] / (own["n"] - 1)
    b = F.array_min(F.transform(others, lambda e: e["d"]))
    s = F.when(own["n"] <= 1, F.lit(0.0)).otherwise(F.coalesce((b - a) / F.greatest(a, b), F.lit(0.0)))
    return x.select(id_col, cluster, s.alias("silhouette"))


NEAR = 1e-4              # squared distances below this share of the squared lengths are summed up anew


def _distances(A: np.ndarray, B: np.ndarray) -> np.ndarray:
    """Euclidean distances of all pairs: |a|^2 + |b|^2 - 2 ab as a matrix product; the few pairs that are so
    near that this would cancel are summed by their differences."""
    aa, bb = np.einsum("ij,ij->i", A, A), np.einsum("ij,ij->i", B, B)
    size = aa[:, None] + bb
    if not np.isfinite(size).all():
        return np.sqrt(_powers(A, B, 2))
    d = size - 2 * (A @ B.T)
    i, j = np.nonzero(d < NEAR * size)
    for at in range(0, len(i), STRIP // 64):
        k, m = i[at:at + STRIP // 64], j[at:at + STRIP // 64]
        diff = A[k] - B[m]
        d[k, m] = np.einsum("ij,ij->i", diff, diff)
    return np.sqrt(d, out=d)


def _by_cluster(ids: np.ndarray, X: np.ndarray, c: np.ndarray):
    """Rows in the order of their cluster: ids, vectors, numbers of the clusters, the clusters' names and sizes."""
    names, at = np.unique(c.astype(str), return_inverse=True)
    order = np.argsort(at, kind="stable")
    return ids[order], X[order], at[order], names, np.bincount(at)


def _sum_rows(ids: np.ndarray, sums: np.ndarray, names: np.ndarray, n: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"id": np.repeat(ids, len(names)), "c": np.tile(names, len(ids)).astype(object), "dsum": sums.ravel(),
                         "cnt": np.tile(n, len(ids)).astype(np.int64)})


def _sil_tile(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of every row of either side the sum of its distances to each cluster of the other; a tile of one block with
    itself has them one way."""
    sides = _sides(pdf)
    if sides is None:
        return pd.DataFrame({"id": [], "c": [], "dsum": [], "cnt": []})
    ids, A, other, B, cb = sides
    shift = B.mean(axis=0)
    A, B = (A - shift, B - shift) if np.isfinite(shift).all() else (A, B)
    ids, A, at_a, names_a, n_a = _by_cluster(ids, A, pdf.loc[pdf["_side"] == 0, "_label"].to_numpy())
    other, B, _, names_b, n_b = _by_cluster(other, B, cb)
    start = np.cumsum(n_b) - n_b
    rows, cols = np.zeros((len(A), len(names_b))), np.zeros((len(names_a), len(B)))
    step = max(1, STRIP // len(B))
    for i in range(0, len(A), step):
        d, part = _distances(A[i:i + step], B), at_a[i:i + step]
        rows[i:i + step] = np.add.reduceat(d, start, axis=1)
        first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        cols[part[first]] += np.add.reduceat(d, first, axis=0)
    out = _sum_rows(ids, rows, names_b, n_b)
    if pdf["qb"].iloc[0] == pdf["rb"].iloc[0]:
        return out
    return pd.concat([out, _sum_rows(other, cols.T, names_a, n_a)], ignore_index=True)


def silhouette_rows(df: DataFrame, cluster: str = "cluster", vec: str = "vec", id_col: str = "id",
                    block: int = QUERIES) -> DataFrame:
    """N7 (plain Euclidean): a(i) = mean distance to the rest of its cluster, b(i) = the
    smallest mean distance to another cluster; s = (b - a) / max(a, b), 0 for singletons.
    Distance sums per (row, cluster) come from block tiles, each pair of blocks once; the exact
    O(n²) work runs as matrix products inside tasks and only n·k partial sums per tile leave a task."""
    src = df.select(F.col(id_col).alias("id"), F.col(vec).alias("vec"), F.col(cluster).cast("string").alias("cl"))
    t = block_tiles(src, _sil_tile, "id long, c string, dsum double, cnt long", label="cl", block=block)
    per = t.groupBy("id", "c").agg(F.sum("dsum").alias("dsum"), F.sum("cnt").alias("cnt"))
    j = per.join(src.select("id", "cl"), "id")
    g = j.groupBy("id", "cl").agg(
        F.max(F.when(F.col("c") == F.col("cl"), F.col("dsum") / (F.col("cnt") - 1))).alias("a"),
        F.max(F.when(F.col("c") == F.col("cl"), F.col("cnt"))).alias("n_own"),
        F.min(F.when(F.col("c") != F.col("cl"), F.col("dsum") / F.col("cnt"))).alias("b"))
    s = F.when(F.col("n_own") <= 1, F.lit(0.0)).otherwise(
        F.coalesce((F.col("b") - F.col("a")) / F.greatest("a", "b"), F.lit(0.0)))
    return g.select(F.col("id").alias(id_col), F.col("cl").alias(cluster), s.alias("silhouette"))


def silhouette_summary(rows: DataFrame, cluster: str = "cluster", digits: int = 4) -> DataFrame:
    """Mean silhouette, size and share of negative values per cluster, and overall (NULL cluster)."""
    r = rows.groupBy(F.col(cluster).alias(cluster)).agg(F.sum("silhouette").alias("_s"), F.count(F.lit(1)).alias("n"),
                                                        F.sum(F.when(F.col("silhouette") < 0, 1).otherwise(0)).alias("_neg"))
    total = r.agg(F.lit(None).cast("string").alias(cluster), F.sum("_s").alias("_s"), F.sum("n").alias("n"), F.sum("_neg").alias("_neg"))
    return r.unionByName(total).select(cluster, "n", F.round(F.col("_s") / F.col("n"), digits).alias("mean_silhouette"),
                                       F.round(F.col("_neg") / F.col("n"), digits).alias("negative_share"))


def purity(df: DataFrame, cluster: str, cls: str, digits: int = 4) -> DataFrame:
    """Σ over clusters of the largest class count, divided by N."""
    c = df.groupBy(cluster, cls).agg(F.count(F.lit(1)).alias("n"))
    m = c.groupBy(cluster).agg(F.max("n").alias("m"), F.sum("n").alias("t"))
    return m.agg(F.round(F.sum("m") / F.sum("t"), digits).alias("purity"))


def ari(df: DataFrame, a: str, b: str, digits: int = 4) -> DataFrame:
    """Adjusted Rand index from the contingency table (sums of n(n-1)/2)."""
    c2 = lambda x: x * (x - 1) / 2
    cells = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    s_ij = cells.select(F.sum(c2(F.col("n")))).scalar()
    s_i = cells.groupBy(a).agg(F.sum("n").alias("r")).select(F.sum(c2(F.col("r")))).scalar()
    s_j = cells.groupBy(b).agg(F.sum("n").alias("r")).select(F.sum(c2(F.col("r")))).scalar()
    n = cells.select(F.sum("n")).scalar()
    exp = s_i * s_j / c2(n)
    val = (s_ij - exp) / (0.5 * (s_i + s_j) - exp)
    return df.sparkSession.range(1).select(F.round(val, digits).alias("ari"))


def cluster_sizes(df: DataFrame, cluster: str) -> DataFrame:
    """Smallest and largest cluster and the number of clusters."""
    s = df.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"))
    return s.agg(F.min("n").alias("smallest"), F.max("n").alias("largest"), F.count(F.lit(1)).alias("k"))


def explained_share(df: DataFrame, cluster: str = "cluster", vec: str = "vec", digits: int = 4) -> DataFrame:
    """1 - SSE(k) / SSE(1), SSE(1) being the total sum of squares about the mean."""
    within = sse(df, cluster, vec, None).select("SSE").scalar()
    total = sse(df.withColumn("_one", F.lit(0)), "_one", vec, None).select("SSE").scalar()
    return df.sparkSession.range(1).select(F.round(1 - within / total, digits).alias("explained_share"),
                                           F.round(total, digits).alias("SSE_1"))


def centroid_arrays(df: DataFrame, cluster: str = "cluster", vec: str = "vec") -> DataFrame:
    """N16 on a vector column: per cluster the mean vector (array) and size."""
    ex = df.select(F.col(cluster).alias("c"), F.posexplode(vec).alias("pos", "x"))
    m = ex.groupBy("c", "pos").agg(F.avg("x").alias("m"))
    arr = m.groupBy("c").agg(F.sort_array(F.collect_list(F.struct("pos", "m"))).alias("_m"))
    n = df.groupBy(F.col(cluster).alias("c")).agg(F.count(F.lit(1)).alias("n"))
    return arr.join(n, "c").select(F.col("c").alias(cluster), "n", F.col("_m.m").alias("centroid"))


def class_table(df: DataFrame, cluster: str, cls: str, digits: int = 4) -> DataFrame:
    """Cluster x class counts, each with its share of the cluster and of the class (coverage)."""
    c = df.groupBy(cluster, cls).agg(F.count(F.lit(1)).alias("n"))
    share = lambda by: F.round(F.col("n") / F.sum("n").over(Window.partitionBy(by)), digits)
    return c.withColumn("cluster_share", share(cluster)).withColumn("class_coverage", share(cls))
