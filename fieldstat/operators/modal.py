"""Modal value per entity with its purity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def modal_value(df: DataFrame, keys: Sequence[str] = ("player_id", "team_name"),
                col: str = "position_name", out: str = "position",
                purity: str = "pos_purity", digits: int = 3,
                keep_null_value: bool = False) -> DataFrame:
    """Most frequent value per entity (ties -> smallest value) and count/total.

    Written as two hash aggregates instead of ROW_NUMBER over a window: the
    second aggregate keeps min(struct(-cnt, value)), so partial aggregation
    applies and no entity's rows are ever gathered into one task.
    ``keep_null_value`` counts NULL as its own value (the class-level variant,
    where unmapped roles form a NULL class).
    """
    keys = list(keys)
    src = df.where(F.col(keys[0]).isNotNull())
    if not keep_null_value:
        src = src.where(F.col(col).isNotNull())
    counted = src.groupBy(*keys, col).agg(F.count(F.lit(1)).alias("_cnt"))
    best = counted.groupBy(*keys).agg(
        F.min(F.struct((-F.col("_cnt")).alias("neg"), F.col(col).alias("v"))).alias("_best"),
        F.sum("_cnt").alias("_total"))
    return best.select(*keys, F.col("_best.v").alias(out),
                       F.round(-F.col("_best.neg") / F.col("_total"), digits).alias(purity))
