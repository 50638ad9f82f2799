"""Adapters from the driver tables to the event layer and the modelling set.

The ``events`` table plays the flat event layer:

  match_id       yyyymmdd of ts (one session per day)
  minute/second  minute of the day, second of the minute
  player_id      user_id; team_name = 'team_' || user_id % 5
  position_name  one of the 22 roles, picked by props.k % 22
  loc_x, loc_y   props.k * 1.2, least(value, 80)
  pass_outcome   NULL (= success) when event_id % 4 = 0
  markers        error = session end, signup = lineup, first purchase of a
                 user in a day = substitution (off = user, on = props.k)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldstat.functions import vocab
from fieldstat.functions.columns import clock_seconds

# Counters of the driver event layer: one per event type plus conditional ones.
DRIVER_COUNTERS = [
    ("clicks", "click", None, None),
    ("clicks_completed", "click", "pass_outcome IS NULL", None),
    ("long_clicks", "click", "pass_length >= 30", None),
    ("key_clicks", None, "pass_shot_assist = true", None),
    ("assists", None, "pass_goal_assist = true", None),
    ("views", "view", None, None),
    ("views_completed", "view", "dribble_outcome = 'Complete'", None),
    ("purchases", "purchase", None, None),
    ("goals", None, "shot_outcome = 'Goal'", None),
    ("xg", None, None, "shot_xg"),
    ("signups", "signup", None, None),
    ("tackles", "signup", "duel_type = 'Tackle'", None),
    ("errors", "error", None, None),
]
DRIVER_RATIOS = [
    ("click_completion_pct", "clicks_completed", "clicks", 3),
    ("view_success_pct", "views_completed", "views", 3),
    ("avg_click_value", "pass_length_sum", "clicks", 2),
]
DRIVER_MARKERS = {"end": "error", "lineup": "signup", "substitution": "purchase",
                  "length_type": "click"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k() -> F.Column:
    return F.get_json_object("props", "$.k").cast("int")


def event_layer(events: DataFrame) -> DataFrame:
    """The 18-column flat event layer (plus event_id) from the driver ``events`` table."""
    k = _k()
    roles = F.array(*[F.lit(r) for r in vocab.ROLES])
    et = F.col("event_type")
    return events.select(
        F.date_format("ts", "yyyyMMdd").cast("int").alias("match_id"),
        (F.hour("ts") * 60 + F.minute("ts")).cast("bigint").alias("minute"),
        F.second("ts").cast("bigint").alias("second"),
        et.alias("event_type"),
        F.col("user_id").alias("player_id"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("player_name"),
        F.concat(F.lit("team_"), (F.col("user_id") % 5).cast("string")).alias("team_name"),
        F.element_at(roles, (k % 22 + 1)).alias("position_name"),
        F.when(F.col("event_id") % 4 != 0, F.lit("Incomplete")).alias("pass_outcome"),
        F.col("value").alias("pass_length"),
        F.when(k % 25 == 0, F.lit(True)).alias("pass_goal_assist"),
        F.when(k % 10 == 0, F.lit(True)).alias("pass_shot_assist"),
        F.when(et == "purchase", F.col("value") / 500.0).alias("shot_xg"),
        F.when((et == "purchase") & (F.col("value") >= 250), F.lit("Goal")).alias("shot_outcome"),
        F.when((et == "view") & (F.col("event_id") % 3 == 0), F.lit("Complete")).alias("dribble_outcome"),
        F.when((et == "signup") & (k % 2 == 0), F.lit("Tackle")).alias("duel_type"),
        (k * 1.2).alias("loc_x"),
        F.least(F.col("value"), F.lit(80.0)).alias("loc_y"),
        F.col("event_id"),
        k.alias("k"),
    )


def lineups(layer: DataFrame, marker: str = "signup") -> DataFrame:
    """Starters: each marker event lists (user, k) as an array of structs, exploded.
    A player listed several times in one session starts once."""
    lu = F.array(
        F.struct(F.struct(F.col("player_id").alias("id")).alias("player")),
        F.struct(F.struct(F.col("k").cast("bigint").alias("id")).alias("player")))
    ex = (layer.where(F.col("event_type") == marker)
               .select("match_id", "team_name", F.explode(lu).alias("p")))
    return ex.select("match_id", F.col("p.player.id").alias("player_id"), "team_name").distinct()


def substitutions(layer: DataFrame, marker: str = "purchase") -> DataFrame:
    """First marker event of a user in a session: off = user, on = props.k.

    An aggregate (min of a struct) instead of a window keeps a busy user's
    events spread over many tasks (partial aggregation).
    """
    first = (layer.where(F.col("event_type") == marker)
                  .groupBy("match_id", "player_id", "team_name")
                  .agg(F.min(F.struct(clock_seconds("minute", "second").alias("t"),
                                      F.col("event_id"), F.col("k"))).alias("f")))
    return first.select("match_id", F.col("player_id").alias("off_id"),
                        F.col("f.k").cast("bigint").alias("on_id"), "team_name",
                        F.col("f.t").alias("sub_sec"))
