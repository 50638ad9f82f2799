"""Radix selection and the co-moment pass against plain versions."""

import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldstat.operators import comoments, ranking, selection, stats as S

ODD = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.0, -1.0, 2.0, 3.9999999999999996, 4.0,
       1.7976931348623157e308, -1.7976931348623157e308, float("inf"), float("-inf"), 1e-300, 0.1, 1 / 3, 1e22, 2.0 ** 52, 2.0 ** 53 - 1]


def bits(x):
    n = struct.unpack("<q", struct.pack("<d", abs(x)))[0]
    return -n if x < 0 else n


def test_order_key_is_the_bits(spark):
    rng = random.Random(1)
    values = ODD + [rng.choice([-1, 1]) * math.ldexp(rng.random() + 0.5, rng.randint(-1074, 1023)) for _ in range(3000)]
    rows = selection.with_order_key(spark.createDataFrame([(v,) for v in values], "x double"), "x", "k").collect()
    assert [r.k for r in rows] == [bits(v) for v in values]
    nan = selection.with_order_key(spark.createDataFrame([(float("nan"),)], "x double"), "x", "k").head()
    assert nan.k > bits(float("inf"))


def test_quantiles_of_groups(spark):
    rng = random.Random(2)
    rows = [(g, v) for g, n in (("a", 1), ("b", 2), ("c", 257), (None, 40), ("hot", 3000))
            for v in [rng.choice([rng.gauss(0, 1e-3), rng.gauss(1e6, 10), 7.5, -rng.random()]) for _ in range(n)]]
    rows += [("none", None), ("b", None)] + [("hot", 7.5)] * 3000
    d = spark.createDataFrame(rows, "g string, x double").repartition(5)
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {r[0]: tuple(r[1:]) for r in selection.quantiles(d, "x", probs, ["g"]).collect()}
    for g in {g for g, v in rows if v is not None}:
        want = np.quantile([v for h, v in rows if h == g and v is not None], probs)
        assert got[g] == pytest.approx(tuple(want), rel=1e-12, abs=1e-12)
    assert "none" not in got
    whole = selection.quantiles(d, "x", probs).head()
    assert tuple(whole) == pytest.approx(tuple(np.quantile([v for _, v in rows if v is not None], probs)), rel=1e-12)
    assert selection.quantiles(d.limit(0), "x", [0.5], ["g"]).count() == 0


def test_selection_agrees_with_ranking(spark):
    rng = random.Random(3)
    d = spark.createDataFrame([(i % 7, rng.gauss(0, 1)) for i in range(2000)], "g int, x double")
    a = {r[0]: r[1:] for r in ranking.exact_quantiles(d, "x", [0.25, 0.5], ["g"], few=True).collect()}
    b = {r[0]: r[1:] for r in ranking.exact_quantiles(d, "x", [0.25, 0.5], ["g"], few=False).collect()}
    assert a == b and len(a) == 7


def test_rows_are_not_shuffled(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(5000).select((F.col("id") % 3).alias("g"), F.md5(F.col("id").cast("string")).alias("k"), F.rand(1).alias("x")).write.parquet(path)
    d = spark.read.parquet(path)
    for out in (selection.quantiles(d, "x", [0.5], ["g"]), selection.thresholds(d, "g", "k", 0.8)):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "RepartitionByExpression" not in plan and "Sort" not in plan
        physical = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        for line, below in zip(physical.splitlines(), physical.splitlines()[1:]):
            if "Exchange" in line and "Broadcast" not in line:
                assert "Aggregate(" in below, (line, below)      # counts, before or after they are summed
        assert "rangepartitioning" not in physical and "SortAggregate" not in physical


def test_split_by_threshold(spark):
    rows = [(c, i) for c, n in (("a", 125), ("b", 1), (None, 10), ("c", 2)) for i in range(n)]
    d = spark.createDataFrame(rows, "c string, i int").withColumn("k", F.md5(F.concat_ws(":", "c", "i")))
    for key in (F.col("k"), F.xxhash64("k"), F.conv(F.substring("k", 1, 8), 16, 10).cast("double")):
        got = ranking.stratified_split(d, "c", 0.8, key=key).withColumn("key", key).collect()
        for c, n in (("a", 100), ("b", 1), (None, 8), ("c", 1)):
            mine = sorted((r for r in got if r.c == c), key=lambda r: r.key)
            assert [r.is_train for r in mine] == [i < n for i in range(len(mine))]
    tied = spark.createDataFrame([("x", k) for k in (1, 2, 2, 2, 3)], "c string, k int")
    assert sorted((r.k, r.is_train) for r in ranking.stratified_split(tied, "c", 0.3, key=F.col("k")).collect()) == [
        (1, True), (2, True), (2, True), (2, True), (3, False)]
    assert ranking.stratified_split(d.limit(0), "c", 0.8, key=F.col("k")).count() == 0


def test_co_moments(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 5)) @ rng.normal(size=(5, 5)) + np.array([1e8, -1e8, 0, 5, 1e-6])
    x[:, 4] = 3.0
    rows = [tuple(float(v) for v in r) for r in x]
    d = spark.createDataFrame(rows, "a double, b double, c double, d double, e double").repartition(7)
    state = comoments.co_moments(d, list("abcde"))
    assert np.allclose(np.diag(state.mean), x.mean(0), rtol=1e-13) and (state.n == 400).all()
    assert np.allclose(state.product, (x - x.mean(0)).T @ (x - x.mean(0)), rtol=1e-6)
    got = {(r.row, r.col): r.value for r in S.corr_matrix(d, list("abcde"), None).collect()}
    want = np.corrcoef(x[:, :4].T)
    for i, p in enumerate("abcd"):
        for j, q in enumerate("abcd"):
            assert got[p, q] == pytest.approx(want[i, j], abs=1e-7)
    assert got["a", "e"] is None and got["e", "e"] == 1.0
    shares = comoments.explained_shares(comoments.co_moments(d, list("abcd")))
    assert shares == pytest.approx(np.sort(np.linalg.eigvalsh(want))[::-1] / 4, abs=1e-6)


def test_co_moments_with_gaps_and_any_partitioning(spark):
    rng = random.Random(5)
    rows = [tuple(None if rng.random() < 0.2 else rng.gauss(1e8, 1) for _ in range(3)) for _ in range(300)] + [(None, None, None)] * 20
    d = spark.createDataFrame(rows, "a double, b double, c double")
    for n in (1, 4, 60):
        got = {(r.row, r.col): r.value for r in S.corr_matrix(d.repartition(n), list("abc"), None).collect()}
        for i, p in enumerate("abc"):
            for j, q in enumerate("abc"):
                both = [(r[i], r[j]) for r in rows if r[i] is not None and r[j] is not None]
                assert got[p, q] == pytest.approx(np.corrcoef(np.array(both).T)[0, 1], abs=1e-6)
    assert S.corr_matrix(d.limit(0), ["a", "b"]).count() == 4
    plan = [s for s in (comoments.co_moments(d, ["a", "b"]),)]
    assert plan[0].n[0, 1] > 0
