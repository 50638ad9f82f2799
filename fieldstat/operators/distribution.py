"""The aggregates behind distribution plots."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldstat.operators.basic import null_safe_join
from fieldstat.operators.ranking import exact_quantiles


def histogram(df: DataFrame, col: str, bins: int, digits: int | None = None) -> DataFrame:
    """Equal-width bins over [min, max]; the maximum falls in the last bin.

    min and max are scalar subqueries (merged into one aggregate by Catalyst):
    no cross join, no collect."""
    src = df.where(F.col(col).isNotNull()).select(F.col(col).cast("double").alias("_x"))
    mn = src.select(F.min("_x")).scalar()
    mx = src.select(F.max("_x")).scalar()
    n = src.select(F.count(F.lit(1))).scalar()
    w = (mx - mn) / F.lit(float(bins))
    b = F.when(w > 0, F.least(F.floor((F.col("_x") - mn) / w), F.lit(bins - 1))).otherwise(F.lit(0))
    h = src.groupBy(b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    lo = mn + F.col("bin") * w
    out = h.select("bin", lo.alias("lo"), (lo + w).alias("hi"), "n",
                   F.try_divide(F.col("n").cast("double"), n * w).alias("density"))
    if digits is not None:
        out = out.select("bin", *[F.round(c, digits).alias(c) for c in ("lo", "hi")], "n",
                         F.round("density", digits).alias("density"))
    return out


def raster(df: DataFrame, x: str, y: str, res: int) -> DataFrame:
    """2-D equal-width counts on a res x res grid."""
    src = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
        F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
    cells = []
    for c in ("_x", "_y"):
        mn = src.select(F.min(c)).scalar()
        mx = src.select(F.max(c)).scalar()
        w = (mx - mn) / F.lit(float(res))
        cells.append(F.when(w > 0, F.least(F.floor((F.col(c) - mn) / w), F.lit(res - 1)))
                      .otherwise(F.lit(0)).cast("int"))
    return src.groupBy(cells[0].alias("cx"), cells[1].alias("cy")).agg(F.count(F.lit(1)).alias("n"))


def grid_counts(df: DataFrame, cls: str, x: str, y: str, step: float) -> DataFrame:
    """Fixed-step grid per class: floor(v / step) * step."""
    g = lambda c: (F.floor(F.col(c) / F.lit(step)) * F.lit(step)).cast("double")
    src = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    return src.groupBy(F.col(cls).alias(cls), g(x).alias("gx"), g(y).alias("gy")).agg(
        F.count(F.lit(1)).alias("n"))


FEW_GROUPS = 100_000


def box_stats(df: DataFrame, group: str, col: str) -> DataFrame:
    """Quartiles, whiskers at 1.5 IQR (most extreme values inside) and outlier count.

    NULL is a group of its own. Values are counted first, so a hot value is one
    row; the quartiles, one row per group, are broadcast if there are at most
    ``FEW_GROUPS`` of them."""
    src = (df.where(F.col(col).isNotNull()).groupBy(group, F.col(col).cast("double").alias("_x"))
             .agg(F.count(F.lit(1)).alias("_c")))
    q = exact_quantiles(df, col, [0.25, 0.5, 0.75], [group], ["q1", "median", "q3"])
    few = q.limit(FEW_GROUPS + 1).count() <= FEW_GROUPS
    j = null_safe_join(src, F.broadcast(q) if few else q, [group])
    iqr = F.col("q3") - F.col("q1")
    lo_f, hi_f = F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr
    return j.groupBy(group).agg(
        F.max("q1").alias("q1"), F.max("median").alias("median"), F.max("q3").alias("q3"),
        F.min(F.when(F.col("_x") >= lo_f, F.col("_x"))).alias("lower_whisker"),
        F.max(F.when(F.col("_x") <= hi_f, F.col("_x"))).alias("upper_whisker"),
        F.sum(F.when((F.col("_x") < lo_f) | (F.col("_x") > hi_f), F.col("_c")).otherwise(0)).alias("outliers"),
        F.sum("_c").alias("n"))


def kde(df: DataFrame, col: str, grid: int = 512, bw: float | None = None, cut: float = 3.0) -> DataFrame:
    """Gaussian kernel density on an even grid, by linear binning + discrete convolution.

    Each value splits its weight between its two neighbouring grid points (one
    aggregate); the density at grid point g is the sum of w_j phi((g-j) step/bw) / (n bw)
    over all grid points j. The work after binning is bounded by grid squared,
    independent of the row count. ``bw`` defaults to Silverman's rule
    0.9 min(sd, IQR/1.34) n^(-1/5). Range, size and spread are one broadcast row."""
    spark = df.sparkSession
    src = df.where(F.col(col).isNotNull()).select(F.col(col).cast("double").alias("_x"))
    facts = src.agg(F.min("_x").alias("_mn"), F.max("_x").alias("_mx"), F.count(F.lit(1)).alias("_n"),
                    F.stddev_samp("_x").alias("_sd"))
    if bw is None:
        q = exact_quantiles(src, "_x", [0.25, 0.75], [], ["_q1", "_q3"])
        facts = facts.withColumn("_one", F.lit(1)).join(q.withColumn("_one", F.lit(1)), "_one").drop("_one")
        narrow = F.least("_sd", (F.col("_q3") - F.col("_q1")) / 1.34)
        width = F.lit(0.9) * F.when(narrow > 0, narrow).otherwise(F.col("_sd")) * F.pow("_n", F.lit(-0.2))
    else:
        width = F.lit(float(bw))
    facts = facts.select("_n", width.alias("_bw"), (F.col("_mn") - cut * width).alias("_lo"),
                         ((F.col("_mx") - F.col("_mn") + 2 * cut * width) / F.lit(float(grid - 1))).alias("_step"))
    one = F.broadcast(facts.withColumn("_one", F.lit(1)))
    pos = (F.col("_x") - F.col("_lo")) / F.col("_step")
    left = F.floor(pos).cast("int")
    frac = pos - F.floor(pos)
    parts = src.withColumn("_one", F.lit(1)).join(one, "_one").select(F.explode(F.array(
        F.struct(left.alias("j"), (1 - frac).alias("w")),
        F.struct((left + 1).alias("j"), frac.alias("w")))).alias("p"))
    weights = (parts.groupBy(F.col("p.j").alias("j")).agg(F.sum("p.w").alias("w"))
                    .where((F.col("j") >= 0) & (F.col("j") < grid)))
    # Every grid point takes every weight: grid x grid rows at most, whatever the input size.
    spread = weights.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(grid - 1)))).withColumn("_one", F.lit(1))
    u = (F.col("g") - F.col("j")) * F.col("_step") / F.col("_bw")
    dens = spread.join(one, "_one").groupBy("g").agg(F.sum(F.col("w") * F.exp(-u * u / 2)).alias("_s"))
    points = spark.range(grid).select(F.col("id").cast("int").alias("g"), F.lit(1).alias("_one")).join(one, "_one")
    return points.join(dens, "g", "left").select(
        "g", (F.col("_lo") + F.col("g") * F.col("_step")).alias("x"),
        (F.coalesce("_s", F.lit(0.0)) / (F.col("_n") * F.col("_bw") * F.lit(math.sqrt(2 * math.pi)))).alias("density"))


def composition(df: DataFrame, group: str, cls: str, digits: int = 4) -> DataFrame:
    """Class shares within each group (stacked to 100%); the window runs over
    the aggregated (group, class) table, at most #classes rows per group."""
    from pyspark.sql import Window
    c = df.groupBy(group, cls).agg(F.count(F.lit(1)).alias("n"))
    return c.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy(group)), digits))


def error_bars(df: DataFrame, value: str, se: str) -> DataFrame:
    """Value ± standard error."""
    return df.withColumn("lower", F.col(value) - F.col(se)).withColumn("upper", F.col(value) + F.col(se))
