"""Projections, joins, set operations, sorting."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def numeric_features(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Numeric columns of the schema minus exclusions (schema only, no job)."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in set(exclude)]


def select_available(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Select by name list, keeping the names that exist."""
    return df.select(*[n for n in names if n in df.columns])


def per_column(cols: Sequence[str], fn: Callable[[str], Column]) -> list[Column]:
    """One generated expression per listed column (use inside one select / agg)."""
    return [fn(c).alias(c) for c in cols]


def retype(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast columns; values that do not convert become NULL (``try_cast``)."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def suffix_collisions(left: DataFrame, right: DataFrame, keys: Sequence[str],
                      suffixes=("_x", "_y")) -> tuple[DataFrame, DataFrame]:
    """Rename non-key columns present on both sides with suffixes."""
    common = (set(left.columns) & set(right.columns)) - set(keys)
    l2 = left.withColumnsRenamed({c: c + suffixes[0] for c in common})
    r2 = right.withColumnsRenamed({c: c + suffixes[1] for c in common})
    return l2, r2


def unordered_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    """Each unordered pair once (least/greatest + distinct); self-pairs dropped."""
    return (df.where(F.col(a) != F.col(b))
              .select(F.least(a, b).alias(a), F.greatest(a, b).alias(b)).distinct())


def join_on(a: DataFrame, b: DataFrame, keys: Mapping[str, str], how: str = "left") -> DataFrame:
    """C4: join with differently named keys; the right key columns are dropped."""
    cond = reduce(lambda x, y: x & y, [a[l] == b[r] for l, r in keys.items()])
    j = a.join(b, cond, how)
    for r in keys.values():
        j = j.drop(b[r])
    return j


def null_safe_join(a: DataFrame, b: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on same-named keys where NULL equals NULL; keeps the keys of ``a``."""
    right = b.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = reduce(lambda x, y: x & y, [a[k].eqNullSafe(right[f"_r_{k}"]) for k in keys])
    return a.join(right, cond, how).drop(*[f"_r_{k}" for k in keys])


def merge_rankings(tables: Sequence[tuple[DataFrame, str]], on: str) -> DataFrame:
    """Inner-merge ranking tables on a key; value columns get the given names.
    ``tables`` is a list of (df with columns [on, value], new value name)."""
    parts = [df.select(on, F.col(df.columns[1] if df.columns[0] == on else df.columns[0]).alias(name))
             for df, name in tables]
    return reduce(lambda x, y: x.join(y, on, "inner"), parts)


def param_grid(spark: SparkSession, **lists) -> DataFrame:
    """Cartesian product of parameter lists. Lists are driver-side parameters
    (bounded); the product is built here, so no cross join runs in Spark."""
    names = list(lists)
    rows = list(itertools.product(*[lists[n] for n in names]))
    return spark.createDataFrame(rows, names)


def top(df: DataFrame, by: Sequence[Column | str], n: int) -> DataFrame:
    """top n rows (TakeOrderedAndProject: per-partition top-n, then merge)."""
    return df.orderBy(*by).limit(n)
