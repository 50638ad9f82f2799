"""Golden metric values recomputed from the reference's published confusion tables."""

import pytest
from pyspark.sql import functions as F

from fieldstat.functions import vocab
from fieldstat.operators import clusters as C, metrics as M

LV = vocab.CLASS_ORDER
# Golden input: decision-tree confusion matrix (rows = predicted, columns = true).
DT = [[25, 0, 0, 0, 0, 0], [0, 56, 0, 0, 0, 0], [0, 1, 61, 1, 0, 0],
      [0, 3, 5, 69, 5, 0], [0, 0, 1, 4, 63, 6], [0, 0, 0, 0, 4, 38]]
# Golden input: cluster x class table of the chosen k-means solution.
KM = {"C1": [125, 0, 0, 0, 0, 0], "C2": [0, 300, 325, 320, 21, 0], "C3": [0, 0, 7, 48, 339, 217]}


def _pred(spark, table):
    rows = [(LV[j], LV[i]) for i, r in enumerate(table) for j, n in enumerate(r) for _ in range(n)]
    return spark.createDataFrame(rows, "label string, prediction string")


def test_tree_golden(spark):
    p = _pred(spark, DT)
    o = M.overall(p, LV).first()
    assert (o.accuracy, o.kappa, o.errors) == (0.9123, 0.8926, 30)
    m = M.macro(M.by_class(p, LV, digits=None)).first()
    assert (m.macro_precision, m.macro_recall, m.macro_f1, m.macro_balanced_accuracy) == (0.9276, 0.9191, 0.9226, 0.9504)
    assert M.weighted_f1(p, LV).first().weighted_f1 == 0.9131
    conf = {r.predicted: [r[c] for c in LV] for r in M.confusion(p, LV).collect()}
    assert [conf[c] for c in LV] == DT


def test_purity_ari_golden(spark):
    rows = [(c, LV[j]) for c, r in KM.items() for j, n in enumerate(r) for _ in range(n)]
    df = spark.createDataFrame(rows, "cluster string, cls string")
    assert C.purity(df, "cluster", "cls").first().purity == 0.4636
    assert C.ari(df, "cluster", "cls").first().ari == 0.3465


def test_auc_perfect_and_random(spark):
    rows = [("a", 0.9, 0.1), ("a", 0.8, 0.2), ("b", 0.3, 0.7), ("b", 0.1, 0.9)]
    df = spark.createDataFrame(rows, "label string, pa double, pb double")
    assert M.multiclass_auc(df, "label", {"a": "pa", "b": "pb"}).first().auc == 1.0
    tied = spark.createDataFrame([("a", 0.5, 0.5), ("b", 0.5, 0.5)], "label string, pa double, pb double")
    assert M.multiclass_auc(tied, "label", {"a": "pa", "b": "pb"}).first().auc == 0.5


def test_exact_binomial_interval(spark):
    from math import comb

    from pyspark.sql import functions as F

    from fieldstat.operators import metrics as M
    rows = [(312, 342), (322, 342), (320, 342), (0, 7), (7, 7), (1, 1000), (5000, 10_000), (3, 9)]
    d = spark.createDataFrame(rows, "x long, n long")
    lo, hi = M.binomial_interval_cols(F.col("x"), F.col("n"))
    got = {(r.x, r.n): (r.lo, r.hi) for r in d.select("x", "n", lo.alias("lo"), hi.alias("hi")).collect()}
    assert [tuple(round(v, 3) for v in got[k]) for k in rows[:3]] == [(0.877, 0.940), (0.911, 0.964), (0.904, 0.959)]
    assert got[0, 7][0] == 0.0 and got[7, 7][1] == 1.0
    for x, n in rows[:3] + [(3, 9)]:
        low, high = got[x, n]
        assert abs(sum(comb(n, k) * low ** k * (1 - low) ** (n - k) for k in range(x, n + 1)) - 0.025) < 1e-9
        assert abs(sum(comb(n, k) * high ** k * (1 - high) ** (n - k) for k in range(x + 1)) - 0.025) < 1e-9
    assert got[5000, 10_000][0] < 0.4902 + 1e-4 and abs(sum(got[5000, 10_000]) - 1) < 1e-9
