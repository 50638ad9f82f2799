"""Counts, NULL profiles and data-quality checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def value_counts(df: DataFrame, cols: str | Sequence[str], digits: int = 4) -> DataFrame:
    """Counts per value, most frequent first, with the share of all rows.
    The total is a scalar subquery, not a window over the whole result."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    total = df.select(F.count(F.lit(1))).scalar()
    counts = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
    return (counts.withColumn("share", F.round(F.col("n") / total, digits))
                  .orderBy(F.desc("n"), *[F.asc_nulls_first(c) for c in cols]))


def null_profile(df: DataFrame, cols: Sequence[str] | None = None, digits: int = 1) -> DataFrame:
    """NULL count and percentage per column in ONE aggregate, then unpivoted."""
    cols = list(cols or df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("_n"),
                  *[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).alias(c) for c in cols])
    long = wide.unpivot(["_n"], cols, "column", "n_na")
    return (long.select("column", F.col("n_na").cast("bigint").alias("n_na"),
                        F.round(F.lit(100.0) * F.col("n_na") / F.col("_n"), digits).alias("pct_na"))
                .orderBy(F.desc("pct_na"), "column"))


def null_profile_by(df: DataFrame, key: Column, cols: Sequence[str], key_name: str = "grp",
                    digits: int = 1) -> DataFrame:
    """Per group: row count, NULL count of the first column and NULL shares of all."""
    return (df.groupBy(key.alias(key_name))
              .agg(F.count(F.lit(1)).alias("n"),
                   *[F.round(F.lit(100.0) * F.avg(F.when(F.col(c).isNull(), 1.0).otherwise(0.0)),
                             digits).alias(f"pct_na_{c}") for c in cols])
              .orderBy(F.desc("n"), key_name))


def count_where(df: DataFrame, preds: dict[str, Column]) -> DataFrame:
    """Counts of rows meeting each predicate, one pass."""
    return df.agg(*[F.sum(F.when(p, 1).otherwise(0)).cast("bigint").alias(n) for n, p in preds.items()])


def expect_no_nulls(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Hard check; raises if any listed column has a NULL. Returns ``df``."""
    row = df.agg(*[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).alias(c) for c in cols]).first()
    bad = {c: row[c] for c in cols if row[c]}
    if bad:
        raise ValueError(f"NULL values found: {bad}")
    return df


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows minus distinct keys (every repeat counts)."""
    n = df.select(F.count(F.lit(1))).scalar()
    d = df.select(*keys).distinct().select(F.count(F.lit(1))).scalar()
    return df.sparkSession.range(1).select((n - d).alias("duplicates"))
