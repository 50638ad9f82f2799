"""Hand-made fixtures of the feature-table operators (exposure, modal role, counters)."""

import pytest
from pyspark.sql import functions as F

from fieldstat.functions import vocab
from fieldstat.functions.columns import recode
from fieldstat.operators.counters import entity_counters
from fieldstat.operators.exposure import exposure_from_raw
from fieldstat.operators.flatten import flatten_events
from fieldstat.operators.modal import modal_value
from fieldstat.sources.io import RAW_EVENT_SCHEMA


def _raw(spark, rows):
    return spark.createDataFrame(rows, RAW_EVENT_SCHEMA).withColumn("match_id", F.lit(1))


def _ev(minute, second, typ, pid=None, team="A", lineup=None, on=None, loc=None, pas=None):
    return (minute, second, (typ,), (pid, f"p{pid}") if pid else None, (team,), None, loc, pas, None,
            None, None, ((([((x, f"p{x}"),) for x in lineup]),) if lineup else None),
            (((on, f"p{on}"),) if on else None))


def test_exposure_fixture(spark):
    rows = [
        _ev(0, 0, "Starting XI", lineup=[1, 2]),
        _ev(45, 30, "Half End"),
        _ev(60, 15, "Substitution", pid=1, on=3),
        _ev(93, 30, "Half End"),
    ]
    got = {r.player_id: r.minutes for r in exposure_from_raw(_raw(spark, rows)).collect()}
    assert got == pytest.approx({1: 60.25, 2: 93.5, 3: 33.25})


def test_modal_role_tie_and_class_purity(spark):
    roles = ["Left Back"] * 3 + ["Right Back"] * 3 + ["Right Center Midfield"] * 2
    df = spark.createDataFrame([(7, "A", r) for r in roles], "player_id long, team_name string, position_name string")
    m = modal_value(df).first()
    assert (m.position, m.pos_purity) == ("Left Back", 0.375)
    g = df.withColumn("grp", recode("position_name", vocab.ROLE_CLASSES))
    c = modal_value(g, col="grp", out="cls", purity="p", keep_null_value=True).first()
    assert (c.cls, c.p) == ("FB", 0.75)


def test_counters_fixture(spark):
    rows = [
        _ev(1, 0, "Pass", pid=5, loc=[10.0, 5.0], pas=(12.0, None, None, ("Incomplete",))),
        _ev(2, 0, "Pass", pid=5, loc=[90.0, 5.0], pas=(31.0, None, True, None)),
        _ev(3, 0, "Pass", pid=5, loc=[50.0, 5.0], pas=(None, True, None, None)),
        _ev(4, 0, "Pressure"),                       # no player: ignored
        _ev(5, 0, "Carry", pid=5, loc=None),         # no location: counted, not averaged
    ]
    flat = flatten_events(_raw(spark, rows))
    c = entity_counters(flat).first()
    assert (c.passes, c.passes_completed, c.long_passes, c.key_passes, c.assists, c.carries) == (3, 2, 1, 1, 1, 1)
    assert c.n_events == 4 and c.mean_x == pytest.approx(50.0)
    assert (c.touches_f3, c.touches_d3, c.pass_length_sum) == (1, 1, 43.0)
