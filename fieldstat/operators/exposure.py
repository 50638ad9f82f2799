"""Exposure reconstruction: minutes played from start, substitution and end markers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldstat.functions.columns import clock_seconds
from fieldstat.operators.flatten import explode_lineup


def session_end(df: DataFrame, key: str = "match_id", type_col: str = "event_type",
                marker: str = "Half End", minute: str = "minute",
                second: str = "second") -> DataFrame:
    """The latest clock of the marker events per session (seconds and minutes)."""
    end = (df.where(F.col(type_col) == marker)
             .groupBy(key).agg(F.max(clock_seconds(minute, second)).alias("end_sec")))
    return end.withColumn("end_min", F.col("end_sec") / F.lit(60.0))


def substitutions(df: DataFrame, key: str = "match_id", type_col: str = "type.name",
                  marker: str = "Substitution") -> DataFrame:
    """Substitution markers of nested events -> (match_id, off_id, on_id, team_name, sub_sec)."""
    return df.where(F.col(type_col) == marker).select(
        F.col(key).alias("match_id"), F.col("player.id").alias("off_id"),
        F.col("substitution.replacement.id").alias("on_id"),
        F.col("team.name").alias("team_name"), clock_seconds("minute", "second").alias("sub_sec"))


def exposure(match_end: DataFrame, starters: DataFrame, subs: DataFrame,
             per_session: bool = False) -> DataFrame:
    """Starters play from 0 to their substitution (else to the end);
    substitutes from entry to the end; summed per (player_id, team_name).

    Kept as in the reference: a replaced substitute counts to the end, and the
    substitution joins on (session, off_id) only. ``match_end`` and ``subs``
    are one row per session / per substitution, so both joins are narrow
    lookups; AQE turns them into broadcasts when they are small at runtime.
    Clocks are whole seconds (``end_sec``, ``sub_sec``), so the sum is exact
    and minutes are divided out once.
    """
    me = match_end.select("match_id", "end_sec")
    sb = subs.select("match_id", F.col("off_id").alias("player_id"), "sub_sec")
    started = (starters.join(me, "match_id", "inner")
                       .join(sb, ["match_id", "player_id"], "left")
                       .select("match_id", "player_id", "team_name",
                               F.coalesce("sub_sec", "end_sec").alias("secs")))
    came_on = (subs.join(me, "match_id", "inner")
                   .select("match_id", F.col("on_id").alias("player_id"), "team_name",
                           (F.col("end_sec") - F.col("sub_sec")).alias("secs")))
    per_match = started.unionByName(came_on)                                   # G1
    if per_session:
        return per_match.withColumn("mins", F.col("secs") / F.lit(60.0))
    return (per_match.groupBy("player_id", "team_name")
                     .agg(F.sum("secs").alias("seconds"))
                     .withColumn("minutes", F.col("seconds") / F.lit(60.0)))


def exposure_from_raw(raw: DataFrame, key: str = "match_id") -> DataFrame:
    """D9 on nested raw events (markers: Half End, Starting XI, Substitution).
    A player listed several times in a session starts once."""
    flat_end = raw.select(F.col(key).alias("match_id"), F.col("type.name").alias("event_type"),
                          "minute", "second")
    return exposure(session_end(flat_end),
                    explode_lineup(raw, keys=(key,)).distinct(),
                    substitutions(raw, key))
