"""Nested events to the flat event layer."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldstat.functions.columns import coord

# Flat column -> nested field path (the 18-column event layer).
FLAT_MAPPING: dict[str, str] = {
    "match_id": "match_id",
    "minute": "minute",
    "second": "second",
    "event_type": "type.name",
    "player_id": "player.id",
    "player_name": "player.name",
    "team_name": "team.name",
    "position_name": "position.name",
    "pass_outcome": "pass.outcome.name",
    "pass_length": "pass.length",
    "pass_goal_assist": "pass.goal_assist",
    "pass_shot_assist": "pass.shot_assist",
    "shot_xg": "shot.statsbomb_xg",
    "shot_outcome": "shot.outcome.name",
    "dribble_outcome": "dribble.outcome.name",
    "duel_type": "duel.type.name",
}


def flatten_events(df: DataFrame, mapping: Mapping[str, str] = FLAT_MAPPING,
                   location: str = "location", coords=("loc_x", "loc_y")) -> DataFrame:
    """B1: one projection of nested fields; array coordinates via NULL-safe ``get``."""
    cols = [F.col(path).alias(name) for name, path in mapping.items()]
    cols += [coord(location, i).alias(name) for i, name in enumerate(coords)]
    return df.select(*cols)


def explode_lineup(df: DataFrame, keys=("match_id",), lineup: str = "tactics.lineup",
                   team: str = "team.name", event_type: str = "type.name",
                   marker: str = "Starting XI") -> DataFrame:
    """Lateral explode of the lineup array of marker events -> (keys, player_id, team_name)."""
    src = df.where(F.col(event_type) == marker)
    ex = src.select(*[F.col(k) for k in keys], F.col(team).alias("team_name"),
                    F.explode(F.col(lineup)).alias("p"))
    return ex.select(*keys, F.col("p.player.id").alias("player_id"), "team_name")
