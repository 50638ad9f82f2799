"""Recoding by dictionary and ordered labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldstat.functions.columns import ordinal


def mapping_table(spark: SparkSession, groups: Mapping[str, Sequence[str]],
                  key: str = "value", label: str = "label") -> DataFrame:
    rows = [(v, lab) for lab, values in groups.items() for v in values]
    return spark.createDataFrame(rows, f"{key} string, {label} string")


def recode_lookup(spark: SparkSession, df: DataFrame, col: str,
                  groups: Mapping[str, Sequence[str]], out: str) -> DataFrame:
    """The same recode through a dictionary table.

    The dictionary is built from the given mapping (size known on the driver),
    so broadcasting it is safe; the join is a left join with differently
    named keys (C4).
    """
    m = mapping_table(spark, groups, "_rc_value", out)
    return (df.join(F.broadcast(m), df[col] == m["_rc_value"], "left").drop("_rc_value"))


def ordinal_label(df: DataFrame, col: str, levels: Sequence[str], out: str) -> DataFrame:
    """Ordered categories as a 1-based rank column (sort by it)."""
    return df.withColumn(out, ordinal(col, levels))
