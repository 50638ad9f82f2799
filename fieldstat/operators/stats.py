"""Descriptive statistics, correlations, ANOVA, class tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldstat.functions.columns import ordinal
from fieldstat.operators import comoments
from fieldstat.operators.basic import null_safe_join
from fieldstat.operators.ranking import exact_quantiles
from fieldstat.operators.reshape import melt


def describe(df: DataFrame, cols: Sequence[str], digits: int = 3) -> DataFrame:
    """Mean, median, sd, min, max, skewness (type 3 = population skewness ·
    ((n-1)/n)^1.5) per feature; sorted by |skewness|. The median is an exact
    distributed quantile, so no feature's values are gathered in one task."""
    long = melt(df, [], cols)
    base = long.groupBy("feature").agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("sd"),
        F.min("value").alias("min"), F.max("value").alias("max"),
        F.skewness("value").alias("_g1"), F.count("value").alias("_n"))
    med = exact_quantiles(long, "value", [0.5], ["feature"], ["median"], few=True)
    out = base.join(med, "feature", "left")
    skew = F.col("_g1") * F.pow((F.col("_n") - 1) / F.col("_n"), F.lit(1.5))
    return (out.select("feature", *[F.round(c, digits).alias(c) for c in ("mean", "median", "sd", "min", "max")],
                       F.round(skew, digits).alias("skewness"))
               .orderBy(F.abs("skewness").desc(), "feature"))


def summary6(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Min, Q1, median, mean, Q3, max per feature (exact type-7 quartiles)."""
    long = melt(df, [], cols)
    base = long.groupBy("feature").agg(F.min("value").alias("min"), F.avg("value").alias("mean"),
                                       F.max("value").alias("max"))
    q = exact_quantiles(long, "value", [0.25, 0.5, 0.75], ["feature"], ["q1", "median", "q3"], few=True)
    return base.join(q, "feature", "left").select("feature", "min", "q1", "median", "mean", "q3", "max")


def group_means(df: DataFrame, key: str | Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Group size and means."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in cols])


def crosstab(df: DataFrame, a: str, b: str, levels: Sequence | None = None,
             wide: bool = False) -> DataFrame:
    """Two-way counts; long (a, b, n) or wide (one column per level of b)."""
    long = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    if not wide:
        return long
    return long.groupBy(a).pivot(b, list(levels) if levels is not None else None).agg(F.sum("n")).na.fill(0)


def argmax(df: DataFrame, by: str, ret: Sequence[str], minimum: bool = False) -> DataFrame:
    """The row with the largest (or smallest) ``by``; ties go to the smallest ``ret``
    values. One aggregate of one struct, so all values come from the same row."""
    key = F.col(by) if minimum else -F.col(by)
    best = F.min(F.when(F.col(by).isNotNull(), F.struct(key.alias("_k"), *[F.col(r).alias(r) for r in ret], F.col(by).alias("_by"))))
    return df.agg(best.alias("_b")).select(*[F.col(f"_b.{r}").alias(r) for r in ret], F.col("_b._by").alias(by))


def argmax_per_group(df: DataFrame, key: str, by: str, tiebreak: str,
                     ret: Sequence[str] = ()) -> DataFrame:
    """Per group the row with the largest numeric ``by``; NULL loses; ties go to
    the smallest ``tiebreak``. One aggregate of min(struct(...)), not a window."""
    best = F.min(F.struct(F.col(by).isNull().alias("_null"), (-F.col(by)).alias("_neg"),
                          F.col(tiebreak).alias("_tb"), *[F.col(r).alias(r) for r in ret]))
    g = df.groupBy(key).agg(best.alias("_b"))
    return g.select(key, F.col("_b._tb").alias(tiebreak), (-F.col("_b._neg")).alias(by),
                    *[F.col(f"_b.{r}").alias(r) for r in ret])


def spread(df: DataFrame, col: str, groups: Sequence[str] = ()) -> DataFrame:
    """Min, max, range and exact median of a column; NULL is a group of its own."""
    base = (df.groupBy(*groups) if groups else df.groupBy()).agg(
        F.min(col).alias("min"), F.max(col).alias("max"), (F.max(col) - F.min(col)).alias("range"))
    med = exact_quantiles(df, col, [0.5], groups, ["median"])
    if groups:
        return null_safe_join(base, med, list(groups), "left")
    return base.withColumn("median", med.select("median").scalar())


def corr_matrix(df: DataFrame, cols: Sequence[str], digits: int | None = 6) -> DataFrame:
    """D24 (+H3): Pearson correlations of all pairs, as (row, col, value), each over the rows that have
    both columns; NULL where one of them does not vary there, 1 on the diagonal. One scan for any number
    of columns (``comoments``)."""
    cols = list(cols)
    c = comoments.correlations(comoments.co_moments(df, cols))
    rows = [(a, b, 1.0 if i == j else None if np.isnan(c[i, j]) else float(c[i, j])) for i, a in enumerate(cols) for j, b in enumerate(cols)]
    out = df.sparkSession.createDataFrame(rows, "row string, col string, value double")
    return out.withColumn("value", F.round("value", digits)) if digits is not None else out


def corr_pairs(df: DataFrame, cols: Sequence[str], bound: float | None = 0.8,
               n: int | None = None, digits: int = 4) -> DataFrame:
    """Each unordered pair once (B17), |r| above a bound and/or the top n by |r|."""
    m = corr_matrix(df, cols, None).where(F.col("row") < F.col("col"))
    if bound is not None:
        m = m.where(F.abs("value") > bound)
    m = m.select("row", "col", F.round("value", digits).alias("r")).orderBy(F.abs("r").desc(), "row", "col")
    return m.limit(n) if n else m


def anova_f(df: DataFrame, cols: Sequence[str], cls: str, digits: int = 1) -> DataFrame:
    """One-way ANOVA F per feature against a class, ranked.

    Per (feature, class): n, mean m, variance v; M is the feature's mean, found
    first; SSB = sum n (m - M)^2, SSW = sum (n - 1) v, F = [SSB/(k-1)] / [SSW/(N-k)].
    No difference of large sums is taken, so large means lose no digits.
    """
    long = melt(df, [cls], cols)
    per = long.groupBy("feature", cls).agg(
        F.count("value").alias("n"), F.avg("value").alias("m"), F.var_samp("value").alias("v")).where("n > 0")
    whole = per.groupBy("feature").agg((F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("mu"))
    f = per.join(whole, "feature").groupBy("feature").agg(
        F.sum("n").alias("N"), F.count(F.lit(1)).alias("k"),
        F.sum(F.col("n") * (F.col("m") - F.col("mu")) * (F.col("m") - F.col("mu"))).alias("SSB"),
        F.sum((F.col("n") - 1) * F.coalesce(F.col("v"), F.lit(0.0))).alias("SSW"))
    fval = F.try_divide(F.try_divide(F.col("SSB"), F.col("k") - 1), F.try_divide(F.col("SSW"), F.col("N") - F.col("k")))
    return (f.select("feature", F.round(fval, digits).alias("f_value"))
             .orderBy(F.desc_nulls_last("f_value"), "feature"))


def split_balance(train: DataFrame, test: DataFrame, cls: str, digits: int = 3) -> DataFrame:
    """Per class (NULL is one): total, train, test and the train share."""
    sides = train.select(cls, F.lit(1).alias("_t")).unionByName(test.select(cls, F.lit(0).alias("_t")))
    j = sides.groupBy(cls).agg(F.count(F.lit(1)).alias("total"), F.sum("_t").cast("bigint").alias("train"))
    return j.select(cls, "total", "train", (F.col("total") - F.col("train")).alias("test"),
                    F.round(F.col("train") / F.col("total"), digits).alias("train_share"))


def dominant(df: DataFrame, key: str, cls: str, digits: int = 4) -> DataFrame:
    """Per group the most frequent class (ties -> smallest) and its share."""
    counts = df.groupBy(key, cls).agg(F.count(F.lit(1)).alias("_n"))
    g = counts.groupBy(key).agg(F.min(F.struct((-F.col("_n")).alias("neg"), F.col(cls).alias("c"))).alias("_b"),
                                F.sum("_n").alias("n"))
    return g.select(key, F.col("_b.c").alias("dominant"), (-F.col("_b.neg")).alias("dominant_n"), "n",
                    F.round(-F.col("_b.neg") / F.col("n"), digits).alias("dominant_share"))


def supergroup_agreement(df: DataFrame, group: str, cls: str,
                         expected: Mapping[str, str], digits: int = 4) -> DataFrame:
    """Share of rows whose group is the one expected for their class."""
    m = F.create_map(*[x for k, v in expected.items() for x in (F.lit(k), F.lit(v))])
    hit = F.when(F.col(group) == F.element_at(m, F.col(cls)), 1.0).otherwise(0.0)
    return df.agg(F.round(F.avg(hit), digits).alias("agreement"), F.count(F.lit(1)).alias("n"))


def error_pairs(pred: DataFrame, label: str, prediction: str, order: Sequence[str]) -> DataFrame:
    """Misclassified rows per unordered class pair; pairs of adjacent classes flagged."""
    a, b = ordinal(label, order), ordinal(prediction, order)
    err = pred.where(F.col(label) != F.col(prediction)).select(
        F.least(a, b).alias("_lo"), F.greatest(a, b).alias("_hi"))
    lv = F.array(*[F.lit(x) for x in order])
    return (err.groupBy("_lo", "_hi").agg(F.count(F.lit(1)).alias("n"))
               .select(F.element_at(lv, F.col("_lo")).alias("class_a"),
                       F.element_at(lv, F.col("_hi")).alias("class_b"), "n",
                       ((F.col("_hi") - F.col("_lo")) == 1).alias("adjacent"))
               .orderBy(F.desc("n"), "class_a", "class_b"))


def adjacent_error_share(pairs: DataFrame, digits: int = 4) -> DataFrame:
    """Share of all errors that fall between adjacent classes."""
    return pairs.agg(F.sum("n").alias("errors"),
                     F.round(F.sum(F.when(F.col("adjacent"), F.col("n")).otherwise(0)) / F.sum("n"), digits)
                      .alias("adjacent_share"))


RESULT_ROWS = 100_000


def _small(df: DataFrame) -> DataFrame:
    """A result table, at most ``RESULT_ROWS`` rows: checked, as it is then ordered in one task."""
    found = df.limit(RESULT_ROWS + 1).count()
    if found > RESULT_ROWS:
        raise ValueError(f"more than {RESULT_ROWS} rows; use ranking.running_total for a table of data")
    return df


def relative_drop(df: DataFrame, order: str, col: str, out: str = "drop_pct", digits: int = 1) -> DataFrame:
    """E5: percent drop to the previous row, e.g. the elbow table of a k sweep.
    For result tables (one row per k / per day); their size is checked."""
    prev = F.lag(col).over(Window.orderBy(order))
    return _small(df).withColumn(out, F.round(F.lit(100.0) * (prev - F.col(col)) / prev, digits))


def first_reaching(df: DataFrame, order: Sequence[Column], col: str, bound: float,
                   digits: int = 4) -> DataFrame:
    """Rank, cumulative share, and a flag on the first rank whose cumulative share
    reaches ``bound``. For ranked result tables (importances, explained variance); their size is checked."""
    w = Window.orderBy(*order)
    r = (_small(df).withColumn("rank_", F.row_number().over(w).cast("bigint"))
           .withColumn("_cum", F.sum(col).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
                       / F.sum(col).over(Window.partitionBy())))
    first = F.min(F.when(F.col("_cum") >= bound, F.col("rank_"))).over(Window.partitionBy())
    return (r.withColumn("first_reaching", F.col("rank_") == first)
             .withColumn("cum_share", F.round("_cum", digits)).drop("_cum"))
