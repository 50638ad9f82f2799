"""Exact order statistics by radix selection: no sort, no checkpoint, no shuffle of rows.

The key of a value is cut into digits, high ones first. A pass counts the rows of
each digit (map-side, so only counts are shuffled), running totals of at most one
digit's range tell in which bin each wanted rank is, and the next pass counts the
next digit of the rows in those bins alone. The bins of a pass, at most one for
each wanted rank of a group, are broadcast to it, so groups must be few; callers
check that and take ``ranking`` beyond it.

A double's key is the whole number that its bits are, negated for negative
numbers, which orders doubles as they are ordered; 0.0 and -0.0 are one value and
NaN is above infinity, as in a sort. A string's digits are its characters, four at
a time, and at last the whole string, so that keys of any length are exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

FEW_GROUPS = 10_000
DIGIT_BITS = 16
_MOST = np.int64((1 << 63) - 1)     # key of NaN


def with_order_key(df: DataFrame, x: str, out: str) -> DataFrame:
    """``df`` with a double's bits as a signed whole number in the order of the doubles, read from the values'
    memory a batch at a time."""
    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column(x).to_numpy(zero_copy_only=False).astype(np.float64)
            bits = np.abs(v).view(np.int64)
            key = np.where(np.isnan(v), _MOST, np.where(v < 0, -bits, bits))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(key)], [*batch.schema.names, out])

    return df.mapInArrow(keyed, df.select("*", F.lit(0).cast("long").alias(out)).schema)


@dataclass
class Digits:
    """For each pass the bin that the passes before have fixed, and the digit to count; both joined are the next bin."""

    fixed: list[Column]
    digit: list[Column]
    join: Callable[[Column, Column], Column]


def number_digits(key: str) -> Digits:
    """Four digits of 16 bits of a signed whole number."""
    shifts = [64 - DIGIT_BITS * (i + 1) for i in range(64 // DIGIT_BITS)]
    whole = F.col(key)
    digit = [F.shiftright(whole, s) if i == 0 else F.shiftright(whole, s).bitwiseAND((1 << DIGIT_BITS) - 1) for i, s in enumerate(shifts)]
    fixed = [F.lit(0).cast("long")] + [F.shiftright(whole, s) for s in shifts[:-1]]
    return Digits(fixed, digit, lambda a, b: F.shiftleft(a, DIGIT_BITS).bitwiseOR(b))


def string_digits(key: str, passes: int = 4, width: int = 4) -> Digits:
    """Characters of a string, ``width`` at a time, then the whole string."""
    at = [F.substring(key, i * width + 1, width) for i in range(passes)]
    return Digits([F.left(key, F.lit(i * width)) for i in range(passes + 1)], [*at, F.col(key)], F.concat)


def select_ranks(rows: DataFrame, groups: Sequence[str], digits: Digits, ranks: Callable[[Column], Sequence[Column]],
                 value: Column | None = None) -> DataFrame:
    """(groups, n, value, _r0, _r1, ...): of every group the keys of the wanted ranks; a column _r is not null
    in the row that its rank falls on.

    ``ranks`` makes the wanted ranks (from 1) of a group's number of rows. ``value`` is the same for all rows of one
    key, by default the last digit. NULL is a group of its own."""
    groups = list(groups)
    wanted = None
    for i, (fixed, digit) in enumerate(zip(digits.fixed, digits.digit)):
        last = i == len(digits.digit) - 1
        level = rows.withColumns({"_bin": fixed, "_digit": digit})
        count = [F.count(F.lit(1)).alias("_c")] + ([F.max(value).alias("value")] if last and value is not None else [])
        if wanted is None:
            counts = level.groupBy(*groups, "_digit").agg(*count)
            counts = counts.withColumn("n", F.sum("_c").over(Window.partitionBy(*groups)))
            places = [f"_r{j}" for j in range(len(ranks(F.col("n"))))]
            counts = counts.withColumns(dict(zip(places, ranks(F.col("n")))))
            within = groups
        else:
            on = level["_bin"] == wanted["_bin"]
            for g in groups:
                on = on & level[g].eqNullSafe(wanted[g])
            kept = level.join(F.broadcast(wanted), on).drop(*[wanted[c] for c in (*groups, "_bin")])
            # Only numbers are carried, so that the aggregate hashes and does not sort.
            counts = kept.groupBy(*groups, "_bin", "_digit").agg(*count, *[F.first(c).alias(c) for c in ("n", *places)])
            within = [*groups, "_bin"]
        upto = F.sum("_c").over(Window.partitionBy(*within).orderBy("_digit").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        before = F.col("_upto") - F.col("_c")
        here = {c: F.when((F.col(c) > before) & (F.col(c) <= F.col("_upto")), F.col(c) - before) for c in places}
        found = counts.withColumn("_upto", upto).withColumns(here).where(F.coalesce(*places).isNotNull())
        if last:
            return found.select(*groups, "n", F.col("_digit" if value is None else "value").alias("value"), *places)
        bin_ = digits.join(F.col("_bin"), F.col("_digit")) if i else F.col("_digit")
        wanted = found.select(*groups, bin_.alias("_bin"), "n", *places)


def few_groups(df: DataFrame, groups: Sequence[str], most: int = FEW_GROUPS) -> bool:
    """Whether a table has at most ``most`` groups."""
    return not groups or df.select(*groups).distinct().limit(most + 1).count() <= most


def quantiles(df: DataFrame, value: str, probs: Sequence[float], groups: Sequence[str] = (),
              names: Sequence[str] | None = None) -> DataFrame:
    """Exact quantiles (h = (n - 1) p + 1, interpolated) of few groups; a group without values has no row."""
    names = list(names or [f"q{int(round(p * 100))}" for p in probs])
    src = df.where(F.col(value).isNotNull()).select(*groups, F.col(value).cast("double").alias("_x"))
    src = with_order_key(src, "_x", "_key")
    place = lambda n, p: (n - 1) * F.lit(float(p)) + 1

    def ranks(n: Column) -> list[Column]:
        return [up(place(n, p)).cast("long") for p in probs for up in (F.floor, F.ceil)]

    found = select_ranks(src, groups, number_digits("_key"), ranks, F.col("_x"))
    aggs = []
    for i, (name, p) in enumerate(zip(names, probs)):
        lo, hi = (F.max(F.when(F.col(f"_r{2 * i + up}").isNotNull(), F.col("value"))) for up in (0, 1))
        h = place(F.max("n"), p)
        aggs.append((lo + (h - F.floor(h)) * (hi - lo)).alias(name))
    return found.groupBy(*groups).agg(*aggs)


def with_sort_key(df: DataFrame, key: Column, out: str) -> DataFrame | None:
    """``df`` with ``key`` as a string or a whole number that is never null, in the same order, nulls first;
    None for keys of other types."""
    kind = df.select(key.alias(out)).schema[0].dataType
    least = F.lit(-(1 << 63))
    if isinstance(kind, T.StringType):
        return df.withColumn(out, F.coalesce(key, F.lit("")))
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return with_order_key(df.withColumn("_double", key.cast("double")), "_double", out).withColumn(
            out, F.when(F.col("_double").isNull(), least).otherwise(F.col(out))).drop("_double")
    if isinstance(kind, T.IntegralType):
        return df.withColumn(out, F.coalesce(key.cast("long"), least))
    return None


def thresholds(df: DataFrame, group: str, key: str, share: float) -> DataFrame:
    """(group, value): the largest key whose percent rank within the group is at most ``share``; ``key``: a ``sort_key``."""
    def ranks(n: Column) -> list[Column]:
        at = F.floor(F.lit(float(share)) * (n - 1))
        pr = lambda r: r / (n - 1)
        at = F.when(n == 1, 0).when(pr(at + 1) <= share, at + 1).when(pr(at) <= share, at).otherwise(at - 1)
        return [(F.least(at, n - 1) + 1).cast("long")]

    if isinstance(df.schema[key].dataType, T.StringType):
        found = select_ranks(df.select(group, key), [group], string_digits(key), ranks)
    else:
        found = select_ranks(df.select(group, key), [group], number_digits(key), ranks, F.col(key))
    return found.select(group, "value")
