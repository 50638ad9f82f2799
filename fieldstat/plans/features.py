"""Queries of the feature-table slice: counters, exposure, modal role, features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldstat.functions import vocab
from fieldstat.functions.columns import recode
from fieldstat.operators.counters import entity_counters, entity_features
from fieldstat.operators.exposure import exposure, exposure_from_raw, session_end
from fieldstat.operators.flatten import flatten_events
from fieldstat.operators.modal import modal_value
from fieldstat.plans import adapters as A
from fieldstat.plans import oracle_sql as O
from fieldstat.plans.registry import query
from fieldstat.session import shared_dir
from fieldstat.sources.io import RAW_EVENT_SCHEMA, read_events, with_file_key


def layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.event_layer(A.table(spark, sf_dir, "events"))


def driver_counts(ev: DataFrame) -> DataFrame:
    return entity_counters(ev, specs=A.DRIVER_COUNTERS, length_type="click")


def driver_minutes(ev: DataFrame) -> DataFrame:
    return exposure(session_end(ev, marker="error"), A.lineups(ev), A.substitutions(ev))


def driver_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = layer(spark, sf_dir)
    return entity_features(driver_counts(ev), driver_minutes(ev), modal_value(ev),
                           [n for n, *_ in A.DRIVER_COUNTERS], ratios=A.DRIVER_RATIOS)


@query("entity_counters", O.with_(O.EV, O.COUNTS) + f"SELECT {O.COUNT_COLUMNS} FROM counts")
def q_entity_counters(spark, sf_dir):
    """All counters, moments and zone counts in one aggregate."""
    return driver_counts(layer(spark, sf_dir))


@query("session_end", O.with_(O.EV, O.EXPOSURE) + "SELECT match_id, end_sec, end_sec / 60.0 AS end_min FROM ending")
def q_session_end(spark, sf_dir):
    """End of each session from its marker events."""
    return session_end(layer(spark, sf_dir), marker="error")


@query("exposure", O.with_(O.EV, O.EXPOSURE) + "SELECT player_id, team_name, minutes FROM played")
def q_exposure(spark, sf_dir):
    """D9 (+C8, C1, C3, G1): minutes per entity from start / substitution / end markers."""
    return driver_minutes(layer(spark, sf_dir)).drop("seconds")


@query("modal_value", O.with_(O.EV, O.POSITIONS) + "SELECT * FROM positions")
def q_modal_value(spark, sf_dir):
    """Modal role per entity and its purity."""
    return modal_value(layer(spark, sf_dir))


@query("class_purity", O.with_(O.EV, O.CLASSES) + "SELECT * FROM classes")
def q_class_purity(spark, sf_dir):
    """E3 + B9: modal class (roles recoded to six classes) and its purity."""
    ev = layer(spark, sf_dir).where(F.col("position_name").isNotNull())
    grp = ev.select("player_id", "team_name",
                    recode("position_name", vocab.ROLE_CLASSES).alias("pos_grp"))
    return modal_value(grp, col="pos_grp", out="position_group6", purity="purity6",
                       keep_null_value=True)


@query("entity_features", O.with_(O.EV, O.COUNTS, O.EXPOSURE, O.POSITIONS, O.FEATURES)
       + "SELECT * FROM features")
def q_entity_features(spark, sf_dir):
    """Flagship: counters ⋈ exposure ⟕ modal role, rates per 90, ratios, shares."""
    return driver_features(spark, sf_dir)


@query("labelled_features", O.with_(O.EV, O.COUNTS, O.EXPOSURE, O.POSITIONS, O.CLASSES, O.FEATURES) + f"""
SELECT f.*, {O.ROLE_CLASS_CASE.replace('position_name', 'f.position')} AS position_group,
       CAST(list_position({vocab.CLASS_ORDER}, {O.ROLE_CLASS_CASE.replace('position_name', 'f.position')}) AS INTEGER) AS class_rank,
       c.purity6
FROM features f LEFT JOIN classes c ON c.player_id = f.player_id AND c.team_name = f.team""")
def q_labelled_features(spark, sf_dir):
    """Class label by dictionary (broadcast map), its rank, class purity."""
    from fieldstat.operators.recode import ordinal_label, recode_lookup
    feats = driver_features(spark, sf_dir)
    labelled = recode_lookup(spark, feats, "position", vocab.ROLE_CLASSES, "position_group")
    labelled = ordinal_label(labelled, "position_group", vocab.CLASS_ORDER, "class_rank")
    purity = q_class_purity(spark, sf_dir).select("player_id", "team_name", "purity6")
    return (labelled.join(purity.withColumnRenamed("team_name", "team"),
                          ["player_id", "team"], "left"))


@query("event_layer", O.with_(O.EV) + """
SELECT match_id, minute, second, event_type, player_id, player_name, team_name, position_name,
       pass_outcome, pass_length, pass_goal_assist, pass_shot_assist, shot_xg, shot_outcome,
       dribble_outcome, duel_type, loc_x, loc_y FROM ev""")
def q_event_layer(spark, sf_dir):
    """The 18-column flat event layer of the driver events."""
    return layer(spark, sf_dir).drop("event_id", "k")


FILES_PER_SESSION = 4
EVENTS_PER_FILE = 1_000


def marker_events(ev: DataFrame) -> DataFrame:
    """The session markers in the raw event shape: ends, line-ups (arrays), substitutions."""
    def at(sec):
        return [F.floor(sec / 60).cast("bigint").alias("minute"), (sec % 60).cast("bigint").alias("second")]

    def kind(name):
        return F.struct(F.lit(name).alias("name")).alias("type")

    team = F.struct(F.col("team_name").alias("name")).alias("team")
    ends = ev.where(F.col("event_type") == "error").select("match_id", "minute", "second", kind("Half End"))
    one = lambda i: F.struct(F.struct(i.cast("bigint").alias("id")).alias("player"))
    lineup = F.struct(F.array(one(F.col("player_id")), one(F.col("k"))).alias("lineup")).alias("tactics")
    starts = ev.where(F.col("event_type") == "signup").select("match_id", "minute", "second", kind("Starting XI"), team, lineup)
    subs = A.substitutions(ev).select(
        "match_id", *at(F.col("sub_sec")), kind("Substitution"), team, F.struct(F.col("off_id").alias("id")).alias("player"),
        F.struct(F.struct(F.col("on_id").alias("id")).alias("replacement")).alias("substitution"))
    return ends.unionByName(starts, allowMissingColumns=True).unionByName(subs, allowMissingColumns=True)


@query("exposure_from_json", O.with_(O.EV, O.EXPOSURE) + "SELECT player_id, team_name, minutes FROM played")
def q_exposure_from_json(spark, sf_dir):
    """A1, A2, C8, D9 on raw files: events and markers written as files of one JSON array each, read
    back as such, the key taken from the path, line-ups exploded, exposure from the nested records."""
    ev = layer(spark, sf_dir)
    raw = nested_events(ev).unionByName(marker_events(ev), allowMissingColumns=True)
    fields = [c for c in raw.columns if c != "match_id"]
    records = raw.select("match_id", F.to_json(F.struct(*fields)).alias("r"))
    # Each session has as many files as its own events need, so none is one large string.
    files = raw.groupBy("match_id").agg(F.ceil(F.count(F.lit(1)) / EVENTS_PER_FILE).alias("files"))
    records = records.join(files, "match_id")
    part = F.pmod(F.xxhash64("r"), F.col("files")).alias("part")
    arrays = (records.groupBy("match_id", part)
                     .agg(F.concat(F.lit("["), F.array_join(F.collect_list("r"), ",\n"), F.lit("]")).alias("value")))
    path = shared_dir(spark, "raw-arrays")
    (arrays.select("match_id", "value").write.option("maxRecordsPerFile", 1).partitionBy("match_id").text(path))
    back = read_events(spark, path).drop("match_id")
    return exposure_from_raw(with_file_key(back, pattern=r"match_id=([0-9]+)/")).drop("seconds")


def nested_events(ev: DataFrame) -> DataFrame:
    """The flat layer re-nested into the raw event shape (JSON records)."""
    def name(c):
        return F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("name")))
    return ev.select(
        "match_id", "minute", "second",
        F.struct(F.col("event_type").alias("name")).alias("type"),
        F.struct(F.col("player_id").alias("id"), F.col("player_name").alias("name")).alias("player"),
        F.struct(F.col("team_name").alias("name")).alias("team"),
        name("position_name").alias("position"),
        F.array(F.col("loc_x"), F.col("loc_y")).alias("location"),
        F.struct(F.col("pass_length").alias("length"),
                 F.col("pass_goal_assist").alias("goal_assist"),
                 F.col("pass_shot_assist").alias("shot_assist"),
                 name("pass_outcome").alias("outcome")).alias("pass"),
        F.struct(F.col("shot_xg").alias("statsbomb_xg"), name("shot_outcome").alias("outcome")).alias("shot"),
        F.struct(name("dribble_outcome").alias("outcome")).alias("dribble"),
        F.struct(name("duel_type").alias("type")).alias("duel"),
    )


@query("flatten_json", O.with_(O.EV) + """
SELECT match_id, minute, second, event_type, player_id, player_name, team_name, position_name,
       pass_outcome, pass_length, pass_goal_assist, pass_shot_assist, shot_xg, shot_outcome,
       dribble_outcome, duel_type, loc_x, loc_y FROM ev""")
def q_flatten_json(spark, sf_dir):
    """A1, A2, B1, B2: events written as nested JSON, one folder per session, read back
    with an explicit schema, the key taken from the file path, then flattened."""
    path = shared_dir(spark, "raw-json")
    nested = nested_events(layer(spark, sf_dir))
    # A session's rows meet in a few tasks before the write, so it has a few files.
    nested = nested.repartition(F.col("match_id"), F.pmod(F.xxhash64("player.id"), F.lit(FILES_PER_SESSION)))
    nested.write.mode("overwrite").partitionBy("match_id").json(path)
    schema = RAW_EVENT_SCHEMA
    raw = read_events(spark, path, schema=schema, multiline=False)
    raw = with_file_key(raw.drop("match_id"), pattern=r"match_id=([0-9]+)/", name="match_id")
    return flatten_events(raw)
