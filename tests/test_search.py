"""Nested model search against separate fits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldstat.operators import models as ML, tree_search as TS

COLS = ["x", "y", "z", "u"]


@pytest.fixture(scope="module")
def noisy(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(360):
        v = rng.normal(size=4) + np.array([i % 3, (i % 3) ** 2, 0, 0]) * 0.7
        rows.append((i, "abc"[i % 3] if rng.random() < 0.9 else "b", *[float(round(t, 2)) for t in v]))
    return spark.createDataFrame(rows, "id long, label string, x double, y double, z double, u double").withColumn(
        "fold", (F.floor(F.col("id") / 3) % 3).cast("int")).cache()


def test_nested_trees_equal_separate_fits(noisy):
    sets = [{"maxDepth": d, "minInfoGain": g} for d in (0, 1, 3, 6, 12) for g in (0.0, 0.005, 0.03)]
    sets += [{"maxDepth": d, "minInstancesPerNode": 15} for d in (2, 8)] + [{"impurity": "entropy", "maxDepth": d} for d in (3, 9)]
    fits = TS.fits(ML.tree, sets, TS.NESTED)
    assert len(fits) == 3 and sorted(i for f in fits for i, *_ in f.answers) == list(range(len(sets)))
    nested = ML.cross_validate(noisy, COLS, ML.tree, sets, nested=TS.NESTED)
    apart = ML.cross_validate(noisy, COLS, ML.tree, sets)
    assert np.abs(np.array(nested) - np.array(apart)).max() < 1e-12
    assert len({round(sum(f), 6) for f in nested}) > 8


def test_all_scenarios_take_six_fits_a_fold():
    sets = [s for g in ML.TREE_SCENARIOS.values() for s in ML.parameter_sets(g)]
    fits = TS.fits(ML.tree, sets, TS.NESTED)
    assert len(sets) == 27 and len(fits) == 6 and sum(len(f.answers) for f in fits) == 27
    assert fits[0].params["maxDepth"] == 20
    forests = [s for g in ML.FOREST_SCENARIOS.values() for s in ML.parameter_sets(g)]
    found = TS.fits(ML.forest, forests)
    assert sorted(i for f in found for i, *_ in f.answers) == list(range(26))
    assert [f.cost for f in found] == sorted((f.cost for f in found), reverse=True)


def test_walk_of_a_known_tree():
    nodes = TS.Nodes(np.array([0, 1, -1, -1, -1]), np.array([0.5, 2.0, np.nan, np.nan, np.nan]), np.array([1, 2, -1, -1, -1]),
                     np.array([4, 3, -1, -1, -1]), np.array([0.3, 0.1, -1, -1, -1.0]), np.array([0, 0, 0, 1, 2]))
    x = np.array([[0.0, 1.0], [0.5, 3.0], [0.6, 0.0]])
    got = TS.walk(nodes, x, [(0, 0.0), (1, 0.0), (5, 0.0), (5, 0.2), (5, 0.5)])
    assert got.tolist() == [[0, 0, 0], [0, 0, 2], [0, 1, 2], [0, 0, 2], [0, 0, 0]]


def test_fewer_fits_at_once_over_many_rows(noisy, monkeypatch):
    assert [TS.fits_at_once(n, 12) for n in (0, 1_000, 64_000, 430_000, 5_000_000)] == [12, 12, 12, 2, 1]
    monkeypatch.setattr(TS, "KEPT", 0)
    pools = []
    monkeypatch.setattr(TS, "ThreadPool", lambda n, pool=TS.ThreadPool: pools.append(n) or pool(n))
    sets = [{"maxDepth": 1}, {"maxDepth": 2, "impurity": "entropy"}]
    few = ML.cross_validate(noisy, COLS, ML.tree, sets, nested=TS.NESTED)
    assert pools == [1] and few == ML.cross_validate(noisy, COLS, ML.tree, sets, nested=TS.NESTED, parallelism=6)


def test_scores_are_kept_under_a_name(noisy, monkeypatch):
    sets = [{"maxDepth": 2}, {"maxDepth": 4}]
    one = ML.cross_validate(noisy, COLS, ML.tree, sets, nested=TS.NESTED, memo="test state 1")
    monkeypatch.setattr(TS, "cross_validate", lambda *a, **k: [[0.0] * 3] * 2)
    assert ML.cross_validate(noisy, COLS, ML.tree, sets, nested=TS.NESTED, memo="test state 1") == one
    assert ML.cross_validate(noisy, COLS, ML.tree, sets, nested=TS.NESTED, memo="test state 2") == [[0.0] * 3] * 2


def test_input_state_follows_the_files(spark, tmp_path):
    from fieldstat.sources.io import input_state
    path = str(tmp_path / "t.parquet")
    spark.range(5).write.parquet(path)
    first = input_state(spark, path)
    assert input_state(spark, path) == first
    spark.range(6).write.mode("overwrite").parquet(path)
    assert input_state(spark, path) != first


def test_scenario_tables(spark):
    from fieldstat.operators.knn import scenario_tables
    grid = spark.createDataFrame([(1, 2.0, "r", 0.5, 0.1), (3, 2.0, "r", 0.7, 0.1), (3, 1.0, "r", 0.7, 0.2)],
                                 "k int, distance double, kernel string, f1 double, f1_sd double")
    listed = spark.createDataFrame([("S1", 1, 2.0, "r"), ("S1", 3, 2.0, "r"), ("S3", 3, 2.0, "r"), ("S3", 3, 1.0, "r")],
                                   "scenario string, k int, distance double, kernel string")
    got = {(r.scenario, r.k, r.distance): (r.best, r.spread) for r in scenario_tables(grid, listed).collect()}
    assert got == {("S1", 1, 2.0): (False, 0.2), ("S1", 3, 2.0): (True, 0.2), ("S3", 3, 2.0): (False, 0.0), ("S3", 3, 1.0): (True, 0.0)}
