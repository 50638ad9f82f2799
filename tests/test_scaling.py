"""Steps that used to grow faster than their input, on rows of their own."""

import numpy as np
from pyspark.sql import functions as F

from fieldstat.operators import clusters as C, knn as K, models as ML, selection


def _vectors(spark, n, d=4, seed=3):
    x = np.random.default_rng(seed).normal(size=(n, d))
    return x, spark.createDataFrame([(i, f"c{i % 3}", i % 5, [float(v) for v in r]) for i, r in enumerate(x)],
                                    "id long, label string, fold int, vec array<double>")


def test_iterative_input_has_a_task_per_some_rows(spark):
    assert ML.sized(spark.range(30_000)).rdd.getNumPartitions() == 3
    assert ML.sized(spark.range(1_000)).rdd.getNumPartitions() == 1


def test_order_keys_are_read_not_computed(spark):
    d = selection.with_order_key(spark.createDataFrame([(1.5,), (-2.0,), (0.0,), (-0.0,)], "x double"), "x", "k")
    assert [r.k for r in d.orderBy("x").collect()] == [-(1 << 62), 0, 0, 0x3FF8 << 48]
    assert "LOG2" not in d._jdf.queryExecution().toString().upper()


def test_folds_are_cut_into_blocks_by_their_own_rows(spark):
    """With all folds' rows counted as one fold's, every row was copied folds times too often."""
    _, d = _vectors(spark, 600)
    q, r = K.fold_scaled(d, "fold")

    class Count:
        def __init__(self, g, queries):
            self.g, self.n, self.refs = g, queries.num_rows, 0

        def add(self, rid, x, label):
            self.refs += len(rid)

        def rows(self):
            import pyarrow as pa
            yield pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in (self.g, self.n, self.refs)], ["g", "n", "refs"])

    tiles = K.search_tiles(q, r, Count, "g long, n long, refs long", id_col="id", vec="vec", label="label", group="g", block=40, most_refs=160).collect()
    assert sum(t.n * t.refs for t in tiles) == 5 * 120 * 480
    assert sum(t.refs for t in tiles) <= 5 * 480 * 10 and sum(t.n for t in tiles) <= 5 * 120 * 20


def test_silhouette_tiles_are_formed_once_a_pair(spark):
    _, d = _vectors(spark, 200)
    tiles = C.block_tiles(d, lambda t: t[["qb", "rb"]].head(1), "qb long, rb long", label="label", block=20).collect()
    assert len({(t.qb, t.rb) for t in tiles}) == len(tiles) and all(t.qb <= t.rb for t in tiles)


def test_distances_of_equal_and_far_rows():
    x = np.concatenate([np.full((3, 4), 1e6), np.full((2, 4), 1e6) + 1e-3, np.random.default_rng(0).normal(size=(20, 4))])
    want = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    assert np.allclose(C._distances(x, x), want, rtol=1e-9, atol=0)


def test_rough_distances_lose_no_neighbour():
    rng = np.random.default_rng(1)
    x, r = rng.normal(size=(30, 8)) * 100, rng.normal(size=(500, 8)) * 100
    r[100:110] = r[0]
    for p in (1, 2, 3):
        want = K._root(K._powers(x, r, p), p)
        bound = np.sort(want, axis=1)[:, 20]
        row, col, dist = K._within(x, r, p, bound)
        assert set(zip(row, col)) == set(zip(*np.nonzero(want <= bound[:, None])))
        assert (dist == want[row, col]).all()


def test_permuted_rows_meet_near_references_only():
    """The bound keeps every neighbour that a variant can have."""
    rng = np.random.default_rng(5)
    x, r = rng.normal(size=(12, 3)), rng.normal(size=(300, 3))
    changed = rng.normal(size=(12, 6))
    kth = np.sort(np.abs(x[:, None] - r[None]).sum(-1), axis=1)[:, 3]
    import pyarrow as pa
    rows = np.concatenate([kth[:, None], x, changed], axis=1)
    job = K._Permuted(0, pa.table({"_id": pa.array(range(12)), "_vec": pa.array(list(rows))}), 4, 1, 3, 2)
    job.add(np.arange(300), r, pa.array(["a"] * 300))
    got = {(i, v): near for b in job.rows() for i, v, near in zip(*(b.column(c).to_pylist() for c in ("qid", "variant", "near")))}
    for i in range(12):
        for v in range(6):
            y = x[i].copy()
            y[v // 2] = changed[i, v]
            d = np.abs(y - r).sum(-1)
            assert [n["rid"] for n in got[i, v]] == list(np.lexsort((np.arange(300), d))[:4])
