"""NULL groups, hot values, large means, odd ids: cases that once went wrong, each with its plain answer."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldstat.operators import basic, counters, knn as K, metrics as M, ranking as R, stats as S
from fieldstat.operators.distribution import box_stats


def test_null_class_keeps_its_rows(spark):
    rows = [(i, None if i % 5 == 0 else "ab"[i % 2]) for i in range(20)]
    d = spark.createDataFrame(rows, "id long, c string")
    key = F.col("id").cast("double")
    s = R.stratified_split(d, "c", 0.8, key=key)
    assert s.count() == 20
    assert {(r.c, r.n) for r in s.where("is_train").groupBy("c").agg(F.count("*").alias("n")).collect()} == {
        (None, math.floor(0.8 * 3) + 1), ("a", math.floor(0.8 * 7) + 1), ("b", math.floor(0.8 * 7) + 1)}
    assert sorted(r.id for r in R.stratified_folds(d, "c", 3, key=key).collect()) == list(range(20))
    v = d.withColumn("x", F.col("id").cast("double"))
    assert {r.c: r.median for r in S.spread(v, "x", ["c"]).collect()}[None] == 7.5
    assert {r.c: (r.median, r.n) for r in box_stats(v, "c", "x").collect()}[None] == (7.5, 4)


def test_default_random_key(spark):
    d = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(200)], "id long, c string")
    one = R.stratified_split(d, "c").cache()
    assert {r.n for r in one.where("is_train").groupBy("c").agg(F.count("*").alias("n")).collect()} == {80}
    assert one.where("is_train").count() == one.where("is_train").count() == 160


def test_hot_values_are_one_row_when_ranked(spark):
    rng = random.Random(1)
    xs = [rng.choice([0.0] * 8 + list(range(11))) for _ in range(3000)]
    d = spark.createDataFrame([(float(x),) for x in xs], "x double")
    assert R._counted(d, "x", []).count() == 11
    got = R.exact_quantiles(d, "x", [0.1, 0.25, 0.5, 0.9], names=["a", "b", "c", "d"]).head()
    assert [got.a, got.b, got.c, got.d] == pytest.approx(list(np.quantile(xs, [0.1, 0.25, 0.5, 0.9])))
    q = R.qq_pairs(d, "x").orderBy("i").collect()
    assert [r.sample for r in q] == sorted(xs) and [r.i for r in q] == list(range(1, 3001))


def test_round_robin_numbers_items_of_size_zero(spark):
    d = spark.createDataFrame([("a", 1, 5.0), ("a", 2, 0.0), ("a", 3, 7.0), ("b", 1, 4.0), ("b", 2, 4.0), ("b", 3, 4.0)],
                              "g string, i int, size double")
    take = lambda **kw: [f"{r.g}{r.i}" for r in R.round_robin_budget(d, "g", ["i"], "size", 14, **kw).orderBy("size_before").collect()]
    assert take() == ["a1", "b1", "b2", "a3"]
    assert take(group_order=["b", "a"]) == ["b1", "a1", "b2", "b3"]


def test_anova_of_large_means(spark):
    rng = np.random.default_rng(0)
    x = 1e8 + rng.normal(size=3000)
    g = rng.integers(0, 3, 3000)
    parts = [x[g == i] for i in range(3)]
    ssb = sum(len(p) * (p.mean() - x.mean()) ** 2 for p in parts)
    ssw = sum(((p - p.mean()) ** 2).sum() for p in parts)
    want = (ssb / 2) / (ssw / 2997)
    d = spark.createDataFrame([(float(a), str(b)) for a, b in zip(x, g)], "x double, g string")
    assert S.anova_f(d, ["x"], "g", digits=3).head().f_value == pytest.approx(want, abs=2e-3)


def test_fold_scaling_of_large_means(spark):
    rng = np.random.default_rng(1)
    x = 1e8 + rng.normal(size=(300, 2))
    x[:, 1] = 5.0
    d = spark.createDataFrame([(i, i % 3, [float(v) for v in r]) for i, r in enumerate(x)], "id long, fold int, vec array<double>")
    q, r = K.fold_scaled(d, "fold")
    for row in q.collect():
        rest = x[np.arange(300) % 3 != row.g]
        assert row.vec[0] == pytest.approx((x[row.id, 0] - rest[:, 0].mean()) / rest[:, 0].std(ddof=1), abs=1e-6) and row.vec[1] == 0.0
    assert r.count() == 600


@pytest.mark.parametrize("shift", [0, -50, 3_000_000_000_000_000])
def test_permutation_importance(spark, shift):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(120, 3))
    rows = [(i + shift, "ab"[int(r[0] > 0)], [float(v) for v in r]) for i, r in enumerate(x)]
    d = spark.createDataFrame(rows, "id long, label string, vec array<double>")
    out = {r.feature: r for r in K.permutation_importance(d.where(F.col("id") % 2 == 0), d.where(F.col("id") % 2 != 0), ["x", "y", "z"], 3, reps=2,
                                                         levels=["a", "b"]).collect()}
    assert max(out, key=lambda f: out[f].importance) == "x" and sum(r.importance_norm for r in out.values()) == pytest.approx(1, abs=1e-3)
    none = K.permutation_importance(d.withColumn("label", F.lit("a")), d.withColumn("label", F.lit("a")), ["x", "y", "z"], 3, reps=1,
                                    levels=["a", "b"]).collect()
    assert {r.importance for r in none} == {0.0} and {r.importance_norm for r in none} == {None}


def test_permuted_values_are_a_permutation(spark):
    d = spark.createDataFrame([(i, [float(i), 100.0 + i]) for i in range(40)], "id long, vec array<double>")
    got = np.array([r.changed for r in K.permuted_values(d, 2, 3).orderBy("id").collect()])
    for v in range(6):
        assert sorted(got[:, v]) == [float(i + 100 * (v // 3)) for i in range(40)]
    assert (got[:, 0] != got[:, 1]).any() and (got[:, 0] != np.arange(40)).any()


def test_nearest_keeps_ties_by_id():
    d = np.array([[1.0, 0.0, 1.0, 1.0], [2.0, 2.0, 2.0, 2.0]])
    row, col = K._nearest(d, np.array([9, 8, 7, 6]), 2)
    assert list(zip(row, col)) == [(0, 1), (0, 3), (1, 3), (1, 2)]


def test_auc_with_a_class_without_rows(spark):
    rows = [("a", 0.9, 0.1, 0.0), ("a", 0.4, 0.6, 0.0), ("b", 0.2, 0.8, 0.0), ("b", 0.4, 0.6, 0.0)]
    d = spark.createDataFrame(rows, "label string, a double, b double, c double")
    r = M.multiclass_auc(d, "label", {"a": "a", "b": "b", "c": "c"}).head()
    assert (r.auc, r.pairs) == (0.875, 1)


def test_argmax_takes_one_row(spark):
    d = spark.createDataFrame([(1, "z", 5.0), (2, "a", 5.0), (3, "m", 1.0), (4, "q", None)], "i int, s string, x double")
    assert tuple(S.argmax(d, "x", ["i", "s"]).head()) == (1, "z", 5.0)
    assert tuple(S.argmax(d, "x", ["s", "i"]).head()) == ("a", 2, 5.0)
    assert tuple(S.argmax(d, "x", ["i", "s"], minimum=True).head()) == (3, "m", 1.0)


def test_correlation_of_oddly_named_columns(spark):
    d = spark.createDataFrame([(float(i), float(i * i), float(-i)) for i in range(9)], "a__b double, b double, a double")
    got = {(r.row, r.col): r.value for r in S.corr_matrix(d, ["a__b", "b", "a"]).collect()}
    assert got[("a__b", "a")] == -1.0 and got[("a", "a")] == 1.0 and len(got) == 9


def test_features_do_not_depend_on_partitions(spark):
    rng = random.Random(3)
    rows = [(1, "t", "click", round(rng.uniform(0, 99), 2)) for _ in range(400)] + [(2, "t", "click", x) for x in [44.25] * 11 + [44.31]]
    cols = "player_id long, team_name string, event_type string, pass_length double"
    found = set()
    for n in (1, 4, 32):
        d = spark.createDataFrame(rows, cols).repartition(n).withColumns(
            {"player_name": F.lit("p"), "loc_x": F.col("pass_length"), "loc_y": F.col("pass_length")})
        c = counters.entity_counters(d, specs=[("clicks", "click", None, None)], length_type="click")
        minutes = spark.createDataFrame([(1, "t", 60000, 1000.0), (2, "t", 60000, 1000.0)],
                                        "player_id long, team_name string, seconds long, minutes double")
        f = counters.entity_features(c, minutes, None, ["clicks"], ratios=[("avg", "pass_length_sum", "clicks", 2)])
        found.add(tuple(sorted(tuple(r) for r in f.drop("sd_x", "sd_y").collect())))
    assert len(found) == 1
    two = {r[0]: r for r in f.collect()}[2]
    assert two.avg == 44.26 and two.mean_x == 44.26      # 531.06 / 12 = 44.255 exactly


def test_result_tables_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(S, "RESULT_ROWS", 3)
    with pytest.raises(ValueError):
        S.relative_drop(spark.range(5).withColumn("x", F.col("id")), "id", "x")
    assert S.relative_drop(spark.range(1, 4).withColumn("x", 10 / F.col("id")), "id", "x").count() == 3


def test_null_safe_join(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2)], "k string, v int")
    b = spark.createDataFrame([(None, 3), ("y", 4)], "k string, w int")
    assert [tuple(r) for r in basic.null_safe_join(a, b, ["k"]).collect()] == [(None, 1, 3)]


def test_checkpoint_folder_must_be_named_on_a_cluster(monkeypatch):
    from fieldstat import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default: default)

    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(Session())


def test_exact_sums_keep_small_and_large_values(spark):
    rows = [(i % 3, 4e-7, 1e13 + 0.1, 0.1) for i in range(6000)]
    for parts in (1, 4, 32):
        d = spark.createDataFrame(rows, "k int, small double, large double, tenth double").repartition(parts)
        got = {r[0]: tuple(r[1:]) for r in d.groupBy("k").agg(
            *[counters.exact_sum(F.col(c)).cast("double") for c in ("small", "large", "tenth")], counters.exact_mean("small"),
            counters.exact_mean("large")).collect()}
        assert got == {k: (0.0008, 2e16 + 200, 200.0, 4e-7, 1e13 + 0.1) for k in range(3)}


def test_rates_of_large_and_small_counts(spark):
    from fieldstat.functions.columns import per_exposure, safe_ratio
    d = spark.createDataFrame([(1e13, 5400), (0.002, 1), (2.0005, 1)], "x double, s long")
    got = [tuple(r) for r in d.select(per_exposure("x", "s", 5400), safe_ratio("x", "s", 3)).collect()]
    assert got == [(1e13, 1851851851.852), (10.8, 0.002), (10802.7, 2.001)]


def test_w_of_pairs_is_not_the_variance(spark):
    from fieldstat.operators import clusters as C
    rng = np.random.default_rng(8)
    x = 1e7 + rng.normal(size=(60, 3))
    rows = [(i, str(i % 4), [float(v) for v in r]) for i, r in enumerate(x)]
    d = spark.createDataFrame(rows, "id long, cluster string, vec array<double>")
    want = sum(((p[:, None] - p[None]) ** 2).sum() / len(p) for p in (x[i::4] for i in range(4)))
    assert C.w_pairs(d, digits=None).head()[0] == pytest.approx(want, rel=1e-7)
    assert C.sse(d, digits=None).head()["W"] == pytest.approx(want, rel=1e-7)


def test_pivots_skip_cells_and_lose_nothing(spark):
    rng = np.random.default_rng(9)
    centres = rng.uniform(-100, 100, size=(12, 3))
    refs = np.concatenate([centres[rng.integers(0, 12, 700)] + rng.normal(size=(700, 3)), np.tile(centres[0], (300, 1))])
    asked = np.concatenate([centres[rng.integers(0, 12, 80)] + rng.normal(size=(80, 3)), rng.uniform(-100, 100, size=(10, 3))])
    frame = lambda m, at: spark.createDataFrame([(at + i, "ab"[i % 2], [float(v) for v in r]) for i, r in enumerate(m)],
                                                "id long, label string, vec array<double>")
    r, q = frame(refs, 0), frame(asked, 5000)
    for p in (1, 2, 3):
        d = (np.abs(asked[:, None] - refs[None]) ** p).sum(-1) ** (1 / p)
        for k, block in ((1, 1024), (7, 50), (400, 200)):
            found = K.pivot_neighbours(q, r, k, p, block=block, pivots=16).collect()
            got = {(x.qid - 5000, x.rn): (x.rid, x.dist) for x in found}
            assert len(found) == len(asked) * k == len(got)
            for i in range(len(asked)):
                for n, j in enumerate(sorted(range(len(refs)), key=lambda j: (round(d[i, j], 9), j))[:k], 1):
                    assert got[i, n][1] == pytest.approx(d[i, j], abs=1e-9)
            plain = {(x.qid - 5000, x.rn): x.rid for x in K.neighbours(q, r, k, p).collect()}
            assert {key: v[0] for key, v in got.items()} == plain
    cells, _ = K.cells_of(r, 2, pivots=16)
    near = K.visited(frame(asked[:80], 0).select("id", "vec"), cells, 5, 2).select(F.avg(F.size("cells"))).head()[0]
    assert (cells.count > 0).sum() > 8 and near < 0.35 * (cells.count > 0).sum()
    one, two = (K.knn_predict(r, q, 5, 2, block=100, **more).select("qid", "prediction").collect() for more in ({}, {"pivots": 16}))
    assert sorted(one) == sorted(two)
    few = K.pivot_neighbours(q, r.limit(3), 5, 2).groupBy("qid").count().collect()
    assert {x["count"] for x in few} == {3}
