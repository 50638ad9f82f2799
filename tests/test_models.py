"""Invariants of the fitted models on separable data."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldstat.operators import clusters as C, knn as K, models as ML, stats as S

COLS = ["x", "y", "z"]


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(0)
    centres = {"a": (0, 0), "b": (6, 0), "c": (0, 6)}
    rows = [(i, label, *(centres[label] + rng.normal(size=2)).tolist(), float(rng.normal())) for i, label in enumerate("abc" * 40)]
    return spark.createDataFrame(rows, "id long, label string, x double, y double, z double").withColumn(
        "fold", (F.floor(F.col("id") / 3) % 4).cast("int")).cache()


def test_trees(spark, blobs):
    for est in (ML.tree(maxDepth=4), ML.forest(numTrees=15, maxDepth=4)):
        m = ML.fit(blobs, COLS, est)
        p = ML.predict(m, blobs)
        assert p.where("label <> prediction").count() <= 6
        assert p.where(F.abs(F.col("p_a") + F.col("p_b") + F.col("p_c") - 1) > 1e-9).count() == 0
        imp = {r.feature: r.importance for r in ML.importance(spark, m, COLS).collect()}
        assert sum(imp.values()) == pytest.approx(1, abs=1e-3) and imp["z"] < 0.1
        again = ML.predict(ML.fit(blobs, COLS, est), blobs)
        assert again.join(p, "id").where(again["prediction"] != p["prediction"]).count() == 0
        s = ML.model_summary(spark, m).head()
        assert s.depth <= 4 and s.nodes >= 5 and "If" in s.rules


def test_search_finds_and_refits(spark, blobs):
    grids = {"S1": {"maxDepth": [1, 4]}, "S2": {"minInstancesPerNode": [1, 60], "maxDepth": [3]}}
    table, best = ML.search(blobs, COLS, ML.tree, grids)
    rows = table.collect()
    assert len(rows) == 4 and rows[0].best and sum(r.best for r in rows) == 1 and rows[0].f1 == max(r.f1 for r in rows) > 0.9
    assert str(sorted(best.items())) == rows[0].params and best.get("maxDepth") != 1
    assert len(ML.parameter_sets(ML.TREE_SCENARIOS["S2"])) == 15
    assert sum(len(ML.parameter_sets(g)) for g in ML.TREE_SCENARIOS.values()) == 27
    assert sum(len(ML.parameter_sets(g)) for g in ML.FOREST_SCENARIOS.values()) == 26


def test_components(blobs):
    scores, explained = ML.pca(blobs, COLS, 3)
    rows = explained.orderBy("component").collect()
    assert rows[-1].cumulative == pytest.approx(1, abs=1e-3) and ML.n_components(explained, 0.5).head()[0] == 2
    assert scores.count() == 120


def test_kmeans_facts(blobs):
    prep = ML.Pipeline(stages=ML.prepare_stages(COLS, None)).fit(blobs).transform(blobs).cache()
    _, a, facts = ML.clustered(prep, 3)
    rows = a.select("id", "label", F.col("prediction").cast("string").alias("cluster"), ML.vector_to_array("features").alias("vec")).cache()
    assert facts["SSE"] == pytest.approx(C.sse(rows).head()["SSE"], abs=0.1) and facts["W"] == pytest.approx(2 * facts["SSE"], abs=0.2)
    assert facts["purity"] == C.purity(rows, "cluster", "label").head()[0] and facts["ari"] == C.ari(rows, "cluster", "label").head()[0]
    sizes = C.cluster_sizes(rows, "cluster").head()
    assert (facts["smallest"], facts["largest"]) == (sizes.smallest, sizes.largest)
    whole = C.sse(rows.withColumn("cluster", F.lit("1"))).head()["SSE"]
    assert whole == pytest.approx((120 - 1) * 3, abs=1e-3)
    drops = [r["W"] for r in ML.sweep(prep, [2, 3, 4])]
    assert drops == sorted(drops, reverse=True)
    table = C.class_table(rows, "cluster", "label").collect()
    assert sum(r.n for r in table) == 120


def test_bisecting_makes_three(blobs):
    prep = ML.Pipeline(stages=ML.prepare_stages(COLS, None, with_mean=False)).fit(blobs).transform(blobs)
    _, b = ML.bisecting(prep, 3)
    assert b.select("prediction").distinct().count() == 3


def test_silhouette_of_large_means(spark):
    rng = np.random.default_rng(4)
    x = 1e7 + np.concatenate([rng.normal(size=(30, 2)), 8 + rng.normal(size=(30, 2))])
    rows = [(i, str(i // 30), [float(v) for v in r]) for i, r in enumerate(x)]
    d = spark.createDataFrame(rows, "id long, cluster string, vec array<double>")
    near = {r.id: r.silhouette for r in C.silhouette_sq_rows(d).collect()}
    d2 = ((x[:, None] - x[None]) ** 2).sum(-1)
    for i in range(60):
        own = (np.arange(60) // 30 == i // 30)
        a, b = d2[i][own].sum() / 29, d2[i][~own].mean()
        assert near[i] == pytest.approx((b - a) / max(a, b), abs=1e-5)
    s = {r.cluster: r for r in C.silhouette_summary(C.silhouette_rows(d)).collect()}
    assert s[None].n == 60 and s["0"].negative_share == 0.0


def test_grid_on_shared_folds(spark, blobs):
    from fieldstat.operators.basic import param_grid
    vecs = blobs.select("id", "label", "fold", K.to_vector(COLS).alias("vec"))
    g = param_grid(spark, k=[1, 5], distance=[1, 2], kernel=["rectangular", "inv"])
    rows = K.knn_grid(vecs, g, 4, levels=["a", "b", "c"]).collect()
    assert len(rows) == 8 and all(0.8 < r.f1 <= 1 and r.f1_se <= r.f1_sd for r in rows)


def test_adjacent_share(spark):
    d = spark.createDataFrame([("a", "b"), ("b", "a"), ("a", "c"), ("c", "c")], "label string, prediction string")
    r = S.adjacent_error_share(S.error_pairs(d, "label", "prediction", ["a", "b", "c"])).head()
    assert (r.errors, r.adjacent_share) == (3, 0.6667)


@pytest.mark.parametrize("name, scenario, wins", [("tree", "S2", {"minInstancesPerNode": 20, "minInfoGain": 0.01}),
                                                  ("tree", "S3", {"impurity": "entropy", "maxDepth": 5}),
                                                  ("forest", "S2", {"maxDepth": 3, "featureSubsetStrategy": "log2"})])
def test_refit_takes_the_best_set_of_all_scenarios(spark, monkeypatch, name, scenario, wins):
    from fieldstat.plans import all_queries
    grids = {"tree": ML.TREE_SCENARIOS, "forest": ML.FOREST_SCENARIOS}[name]
    assert wins in ML.parameter_sets(grids[scenario])
    monkeypatch.setattr(ML, "cross_validate", lambda train, cols, make, sets, **kw: [[1.0, 1.0] if s == wins else [0.5, 0.5] for s in sets])
    made, make = [], getattr(ML, name)
    monkeypatch.setattr(ML, name, lambda **params: made.append(params) or make(**params))
    out = all_queries()[f"{name}_refit"](spark, "/root/testdata/sf0.001")
    assert made == [wins] and out.count() > 0
