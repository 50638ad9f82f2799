"""Column-level helpers and fixed vocabularies."""

from fieldstat.functions.columns import (
    clock,
    clock_seconds,
    cluster_name,
    coord,
    normal_quantile_sql,
    ordinal,
    per_exposure,
    ratio,
    recode,
    safe_ratio,
)
from fieldstat.functions import vocab

__all__ = [
    "clock", "clock_seconds", "cluster_name", "coord", "normal_quantile_sql",
    "ordinal", "per_exposure", "ratio", "recode", "safe_ratio", "vocab",
]
