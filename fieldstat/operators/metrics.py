"""Classification metrics as DataFrame aggregates over (label, prediction) (M1-M7).

Every metric works on per-class counts (at most classes² rows after the first
aggregate), so the input size only affects one partial-aggregated pass.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def confusion_long(pred: DataFrame, levels: Sequence[str], label: str = "label",
                   prediction: str = "prediction") -> DataFrame:
    """M1 (long): counts for every (predicted, true) pair of levels, zeros included.
    The level grid comes from the level list (bounded), left-joined with the counts."""
    spark = pred.sparkSession
    grid = spark.createDataFrame(list(itertools.product(levels, levels)), "predicted string, actual string")
    counts = pred.groupBy(F.col(prediction).cast("string").alias("predicted"),
                          F.col(label).cast("string").alias("actual")).agg(F.count(F.lit(1)).alias("n"))
    return grid.join(counts, ["predicted", "actual"], "left").na.fill(0, ["n"])


def confusion(pred: DataFrame, levels: Sequence[str], label: str = "label",
              prediction: str = "prediction") -> DataFrame:
    """M1: confusion matrix, rows = predicted, columns = true class, all levels."""
    long = confusion_long(pred, levels, label, prediction)
    return long.groupBy("predicted").pivot("actual", list(levels)).agg(F.sum("n")).na.fill(0)


def _margins(pred: DataFrame, levels: Sequence[str], label: str, prediction: str) -> DataFrame:
    long = confusion_long(pred, levels, label, prediction)
    tp = long.where(F.col("predicted") == F.col("actual")).select(F.col("actual").alias("cls"), F.col("n").alias("tp"))
    rows = long.groupBy(F.col("predicted").alias("cls")).agg(F.sum("n").alias("n_pred"))
    cols = long.groupBy(F.col("actual").alias("cls")).agg(F.sum("n").alias("n_true"))
    tot = long.select(F.sum("n")).scalar()
    return tp.join(rows, "cls").join(cols, "cls").withColumn("N", tot)


def by_class(pred: DataFrame, levels: Sequence[str], label: str = "label", prediction: str = "prediction",
             digits: int | None = 4) -> DataFrame:
    """M3: per class precision, recall, F1, balanced accuracy; undefined -> NULL."""
    m = _margins(pred, levels, label, prediction)
    tp, fp = F.col("tp"), F.col("n_pred") - F.col("tp")
    fn = F.col("n_true") - F.col("tp")
    tn = F.col("N") - F.col("tp") - fp - fn
    prec = F.try_divide(tp.cast("double"), F.col("n_pred").cast("double"))
    rec = F.try_divide(tp.cast("double"), F.col("n_true").cast("double"))
    f1 = F.try_divide(2 * prec * rec, prec + rec)
    spec = F.try_divide(tn.cast("double"), (tn + fp).cast("double"))
    bal = (rec + spec) / 2
    r = lambda c: F.round(c, digits) if digits is not None else c
    return m.select(F.col("cls").alias("class"), r(prec).alias("precision"), r(rec).alias("recall"),
                    r(f1).alias("f1"), r(bal).alias("balanced_accuracy"))


def macro(by_cls: DataFrame, digits: int = 4) -> DataFrame:
    """M4: macro means ignoring undefined classes (avg skips NULL)."""
    return by_cls.agg(*[F.round(F.avg(c), digits).alias(f"macro_{c}")
                        for c in ("precision", "recall", "f1", "balanced_accuracy")])


def overall(pred: DataFrame, levels: Sequence[str], label: str = "label", prediction: str = "prediction",
            digits: int = 4) -> DataFrame:
    """M2: accuracy, Cohen's kappa, no-information rate, errors and n."""
    m = _margins(pred, levels, label, prediction)
    agg = m.agg(F.sum("tp").alias("correct"), F.first("N").alias("n"),
                F.sum(F.col("n_pred") * F.col("n_true")).alias("_pe"), F.max("n_true").alias("_maj"))
    acc = F.col("correct") / F.col("n")
    pe = F.col("_pe") / (F.col("n") * F.col("n"))
    return agg.select(F.round(acc, digits).alias("accuracy"),
                      F.round((acc - pe) / (1 - pe), digits).alias("kappa"),
                      F.round(F.col("_maj") / F.col("n"), digits).alias("no_information_rate"),
                      (F.col("n") - F.col("correct")).cast("bigint").alias("errors"),
                      F.col("n").cast("bigint").alias("n"))


def weighted_f1(pred: DataFrame, levels: Sequence[str], label: str = "label", prediction: str = "prediction",
                digits: int = 4) -> DataFrame:
    """M5: Σ_c (true share of c) · F1_c with undefined F1 -> 0."""
    m = _margins(pred, levels, label, prediction)
    f1 = F.coalesce(F.try_divide(2 * F.col("tp").cast("double"), (F.col("n_pred") + F.col("n_true")).cast("double")),
                    F.lit(0.0))
    return m.agg(F.round(F.sum(F.col("n_true") * f1) / F.sum("n_true"), digits).alias("weighted_f1"))


def multiclass_auc(df: DataFrame, label: str, scores: Mapping[str, str], digits: int = 4) -> DataFrame:
    """M6: Hand-Till multiclass AUC = mean over class pairs of [A(i|j) + A(j|i)] / 2.

    A(i|j): probability that a class-i row scores higher on p_i than a class-j row
    (ties count one half) — a Mann-Whitney statistic. Rows are aggregated to
    (column, score, class) counts first, one row per class column; the count of
    class-j rows below each score is a distributed running sum, so no class is
    ever ranked inside one task. Pairs with a class without rows are undefined
    and left out of the mean and of ``pairs``.
    """
    from fieldstat.operators.ranking import running_total
    classes = list(scores)
    listed = F.array(*[F.struct(F.lit(c).alias("ci"), F.col(scores[c]).cast("double").alias("score")) for c in classes])
    counts = (df.select(F.col(label).cast("string").alias("lab"), F.explode(listed).alias("e"))
                .where(F.col("lab").isin(classes)).groupBy("e.ci", "e.score", "lab").agg(F.count(F.lit(1)).alias("n")))
    # Positives of a column meet every other class; this multiplies distinct scores, not rows.
    others = F.filter(F.array(*map(F.lit, classes)), lambda c: c != F.col("ci"))
    cj = F.when(F.col("lab") == F.col("ci"), others).otherwise(F.array("lab"))
    pos = F.col("lab") == F.col("ci")
    cnt = (counts.withColumn("cj", F.explode(cj)).groupBy("ci", "cj", "score")
                 .agg(F.sum(F.when(pos, F.col("n")).otherwise(0)).alias("npos"),
                      F.sum(F.when(pos, 0).otherwise(F.col("n"))).alias("nneg")))
    run = running_total(cnt, ["score"], ["ci", "cj"], value=F.col("nneg"), out="neg_below", exclusive=True)
    a = run.groupBy("ci", "cj").agg(F.try_divide(
        F.sum(F.col("npos") * (F.col("neg_below") + 0.5 * F.col("nneg"))), F.sum("npos") * F.sum("nneg")).alias("A"))
    pair = F.struct(F.least("ci", "cj").alias("a"), F.greatest("ci", "cj").alias("b"))
    per_pair = a.groupBy(pair.alias("pair")).agg(F.avg("A").alias("a_pair"))
    return per_pair.agg(F.round(F.avg("a_pair"), digits).alias("auc"),
                        F.count("a_pair").alias("pairs"))


def accuracy_interval_cols(acc, n, z: float = 1.959963984540054):
    """M7 as column expressions (for result tables)."""
    den = 1 + z * z / n
    centre = (acc + z * z / (2 * n)) / den
    half = z * F.sqrt(acc * (1 - acc) / n + z * z / (4 * n * n)) / den
    return (centre - half).alias("acc_lower"), (centre + half).alias("acc_upper")


def _log_gamma(x: Column) -> Column:
    """Logarithm of the gamma function for x > 0: Stirling's series ten places above x, and back."""
    y = x + 10
    series = 1 / (12 * y) - 1 / (360 * F.pow(y, 3)) + 1 / (1260 * F.pow(y, 5)) - 1 / (1680 * F.pow(y, 7))
    above = (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series
    return above - sum((F.log(x + i) for i in range(1, 10)), F.log(x))


def _beta_fraction(a: Column, b: Column, z: Column) -> Column:
    """Regularised incomplete beta function where z < (a + 1) / (a + b + 2): its continued fraction from the inside out."""
    depth = (F.lit(50) + F.ceil(8 * F.sqrt(F.greatest(a, b)))).cast("int")

    def outward(f: Column, i: Column) -> Column:
        m = F.floor(i / 2)
        even = m * (b - m) * z / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * z / ((a + 2 * m) * (a + 2 * m + 1))
        return 1 + F.when(i % 2 == 0, even).otherwise(odd) / f

    front = F.exp(a * F.log(z) + b * F.log(1 - z) + _log_gamma(a + b) - _log_gamma(a) - _log_gamma(b)) / a
    return front / F.aggregate(F.sequence(depth, F.lit(1)), F.lit(1.0), outward)


def beta_cdf(a: Column, b: Column, z: Column) -> Column:
    """Regularised incomplete beta function for 0 < z < 1."""
    return F.when(z < (a + 1) / (a + b + 2), _beta_fraction(a, b, z)).otherwise(1 - _beta_fraction(b, a, 1 - z))


def beta_quantile(p: float, a: Column, b: Column, steps: int = 52) -> Column:
    """Its inverse in z, by bisection."""
    start = F.struct(F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi"))

    def halve(acc: Column, _: Column) -> Column:
        mid = (acc["lo"] + acc["hi"]) / 2
        low = beta_cdf(a, b, mid) < p
        return F.struct(F.when(low, mid).otherwise(acc["lo"]).alias("lo"), F.when(low, acc["hi"]).otherwise(mid).alias("hi"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, halve, lambda acc: (acc["lo"] + acc["hi"]) / 2)


def binomial_interval_cols(hits: Column, n: Column, level: float = 0.95) -> tuple[Column, Column]:
    """M7: the exact (Clopper-Pearson) interval of a share ``hits / n`` as column expressions (for result tables)."""
    x, m = hits.cast("double"), n.cast("double")
    tail = (1 - level) / 2
    lower = F.when(x <= 0, F.lit(0.0)).otherwise(beta_quantile(tail, x, m - x + 1))
    upper = F.when(x >= m, F.lit(1.0)).otherwise(beta_quantile(1 - tail, x + 1, m - x))
    return lower, upper
