"""Single-pass per-entity counters and the derived feature table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldstat.functions import vocab
from fieldstat.functions.columns import per_exposure, ratio, safe_ratio

# (name, numerator, denominator, digits) for guarded ratios of the feature table.
FOOTBALL_RATIOS = [
    ("pass_completion_pct", "passes_completed", "passes", 3),
    ("dribble_success_pct", "dribbles_completed", "dribbles", 3),
    ("avg_pass_length", "pass_length_sum", "passes", 2),
]


def counter_expr(type_col: str, event_type: str | None, cond: str | None,
                 value: str | None) -> Column:
    """SUM(CASE WHEN pred THEN 1|coalesce(v, 0) ELSE 0 END); NULL predicates count 0."""
    pred = None
    if event_type is not None:
        pred = F.col(type_col) == F.lit(event_type)
    if cond is not None:
        pred = F.expr(cond) if pred is None else pred & F.expr(cond)
    if value is None:
        return F.sum(F.lit(1)) if pred is None else F.sum(F.when(pred, 1).otherwise(0))
    return F.coalesce(exact_sum(F.expr(value) if pred is None else F.when(pred, F.expr(value))).cast("double"), F.lit(0.0))


_EXACT = "decimal(38,18)"


def exact_sum(value: Column) -> Column:
    """Sum of doubles as decimals of 18 places: the same in any order and partitioning.

    A double is taken by its shortest decimal form, so 0.1 is a tenth; digits beyond the 18th place are
    rounded away, and a sum of 1e20 or more is an error."""
    return F.sum(value.cast(_EXACT))


def exact_mean(col: str) -> Column:
    """Mean from an exact sum: one decimal division, the double next to it; NULL without values."""
    return F.try_divide(exact_sum(F.col(col)), F.count(col).cast("decimal(12,0)")).cast("double")


def entity_counters(df: DataFrame, keys: Sequence[str] = ("player_id", "team_name"),
                    specs=vocab.FOOTBALL_COUNTERS, *, type_col: str = "event_type",
                    name_col: str | None = "player_name", x: str = "loc_x", y: str = "loc_y",
                    length_type: str | None = "Pass", length_col: str | None = "pass_length",
                    final_third: float = vocab.FINAL_THIRD_X,
                    defensive_third: float = vocab.DEFENSIVE_THIRD_X,
                    require: str | None = "player_id") -> DataFrame:
    """D3: every counter, moment and zone count of an entity in ONE hash aggregate.

    Partial aggregation runs before the shuffle, so a key holding a large share
    of the events costs one partial row per input partition, not a hot task.
    """
    src = df.where(F.col(require).isNotNull()) if require else df
    aggs: list[Column] = []
    if name_col:
        aggs.append(F.max(name_col).alias("player"))                       # D7
    aggs += [counter_expr(type_col, t, c, v).alias(n) for n, t, c, v in specs]
    if length_col:
        aggs.append(counter_expr(type_col, length_type, None, length_col).alias("pass_length_sum"))
    aggs += [
        exact_mean(x).alias("mean_x"), exact_mean(y).alias("mean_y"),     # D5
        F.stddev_samp(x).alias("sd_x"), F.stddev_samp(y).alias("sd_y"),   # D6
        F.sum(F.when(F.col(x) >= final_third, 1).otherwise(0)).alias("touches_f3"),    # D13
        F.sum(F.when(F.col(x) <= defensive_third, 1).otherwise(0)).alias("touches_d3"),
        F.count(F.lit(1)).alias("n_events"),
    ]
    return src.groupBy(*keys).agg(*aggs)


def entity_features(counts: DataFrame, minutes: DataFrame, positions: DataFrame | None,
                    counter_names: Sequence[str], *, keys=("player_id", "team_name"),
                    ratios=FOOTBALL_RATIOS, min_exposure: float = vocab.MIN_EXPOSURE,
                    unit: float = vocab.RATE_UNIT) -> DataFrame:
    """The feature table: counters ⋈ exposure (inner) ⟕ modal role, exposure >= threshold.

    All three inputs are already one row per entity, so both joins are
    co-partitioned on the entity key; the exposure filter (B8) is applied
    before the joins by Catalyst.
    """
    keys = list(keys)
    m = minutes.where(F.col("minutes") >= F.lit(min_exposure))                # B8
    j = counts.join(m, keys, "inner")                                          # C2
    if positions is not None:
        j = j.join(positions, keys, "left")                                    # C3
    out = [F.col(keys[0]), F.col("player")]
    out += [F.col(k).alias("team") if k == "team_name" else F.col(k) for k in keys[1:]]
    if positions is not None:
        out += [F.col("position"), F.col("pos_purity")]
    out.append(ratio(F.col("seconds"), F.lit(60), 1).cast("double").alias("minutes"))
    out += [per_exposure(c, "seconds", unit * 60).alias(f"{c}_p90") for c in counter_names]   # D11
    out += [safe_ratio(n, d, dg).alias(name) for name, n, d, dg in ratios]             # D12
    out += [F.round(c, 2).alias(c) for c in ("mean_x", "mean_y", "sd_x", "sd_y")]
    out += [ratio(F.col(c), F.col("n_events"), 3).cast("double").alias(n)               # D13
            for c, n in (("touches_f3", "f3_share"), ("touches_d3", "d3_share"))]
    return j.select(*out)
