"""Means, variances and co-moments of all pairs of columns in one scan.

A partition keeps, for every pair (i, j), over its rows that have both columns: n, the
mean of i, the sum of squares of i about it, and the sum of products of i and j about
their means. A batch's share comes from matrix products of its values less the batch's
means; two shares merge by the pairwise update of means and moments (as in a parallel
variance), so large means lose no digits. Partitions send one state each; states
are merged a few at a time, in levels, so that no task holds more than ``MERGE_BYTES``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MERGE_BYTES = 64 << 20
MOST_PARTITIONS = 1_000_000


@dataclass
class CoMoments:
    """d x d matrices: rows with both columns, mean of the first, its squares and the products about the means."""

    n: np.ndarray
    mean: np.ndarray
    square: np.ndarray
    product: np.ndarray

    @staticmethod
    def of(x: np.ndarray) -> CoMoments:
        """State of the rows of ``x``; NaN is a missing value."""
        have = ~np.isnan(x)
        m = have.astype(float)
        count = have.sum(0)
        shift = np.where(have, x, 0.0).sum(0) / np.maximum(count, 1)
        c = np.where(have, x - shift, 0.0)
        n, s = m.T @ m, c.T @ m
        some = np.maximum(n, 1)
        return CoMoments(n, shift[:, None] + s / some, (c * c).T @ m - s * s / some, c.T @ c - s * s.T / some)

    def merge(self, other: CoMoments) -> CoMoments:
        """State of the rows of both."""
        n = self.n + other.n
        part = other.n / np.maximum(n, 1)
        d = np.where(self.n == 0, 0.0, np.where(other.n == 0, 0.0, other.mean - self.mean))
        mean = np.where(self.n == 0, other.mean, self.mean + d * part)
        w = self.n * part
        return CoMoments(n, mean, self.square + other.square + d * d * w, self.product + other.product + d * d.T * w)

    def pack(self) -> bytes:
        return np.stack([self.n, self.mean, self.square, self.product]).tobytes()

    @staticmethod
    def unpack(data: bytes) -> CoMoments:
        parts = np.frombuffer(data)
        d = math.isqrt(len(parts) // 4)
        return CoMoments(*parts.reshape(4, d, d))


_STATE = "part long, state binary"


def _states(cols: Sequence[str]):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                x = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in cols], axis=1)
                one = CoMoments.of(x)
                total = one if total is None else total.merge(one)
        if total is not None:
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([total.pack()], pa.binary())], ["part", "state"])

    return found


def _merged(key: tuple, states: pa.Table) -> pa.Table:
    total = None
    for data in states.sort_by("part").column("state"):
        one = CoMoments.unpack(data.as_py())
        total = one if total is None else total.merge(one)
    return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "state": pa.array([total.pack()], pa.binary())})


def co_moments(df: DataFrame, cols: Sequence[str]) -> CoMoments:
    """The state of all rows: one scan; four d x d matrices reach the driver."""
    cols = list(cols)
    clean = [F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(f"c{i}") for i, c in enumerate(cols)]
    names = [f"c{i}" for i in range(len(cols))]
    states = df.select(*clean).mapInArrow(_states(names), _STATE)
    fan = max(2, MERGE_BYTES // (32 * len(cols) ** 2))
    for _ in range(math.ceil(math.log(MOST_PARTITIONS, fan))):
        states = states.withColumn("at", F.floor(F.col("part") / fan)).groupBy("at").applyInArrow(_merged, _STATE)
    found = states.collect()
    if not found:
        zero = np.zeros((len(cols), len(cols)))
        return CoMoments(zero, zero, zero, zero)
    return CoMoments.unpack(bytes(found[0]["state"]))


def correlations(state: CoMoments) -> np.ndarray:
    """Pearson correlations; NaN where one of the columns does not vary over the rows that have both."""
    spread = np.sqrt(state.square * state.square.T)
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(spread > 0, state.product / spread, np.nan)


def explained_shares(state: CoMoments) -> np.ndarray:
    """Shares of the variance of the standardised columns that their principal components explain, largest first."""
    c = correlations(state)
    c = np.where(np.isnan(c), 0.0, c)
    constant = np.diag(state.square) <= 0
    np.fill_diagonal(c, np.where(constant, 0.0, 1.0))
    values = np.sort(np.clip(np.linalg.eigvalsh(c), 0.0, None))[::-1]
    return values / max(values.sum(), 1e-300)
