"""Reshaping (H1-H5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def melt(df: DataFrame, ids: Sequence[str], cols: Sequence[str], var: str = "feature",
         val: str = "value", cast: str | None = "double") -> DataFrame:
    """H1/H3: wide to long (``unpivot``); values cast to one type."""
    src = df.select(*ids, *[F.col(c).cast(cast).alias(c) if cast else F.col(c) for c in cols])
    return src.unpivot(list(ids), list(cols), var, val)
