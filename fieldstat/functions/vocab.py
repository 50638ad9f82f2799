"""Fixed values that must equal the reference's for equal results.

FIXED VALUES — role names, the six role classes and their order, and the
counter list of the per-entity feature table, as the reference defines them.
"""

# FIXED VALUES: the 22 detailed roles, grouped by class, in the reference's order.
ROLE_CLASSES = {
    "GK": ["Goalkeeper"],
    "CB": ["Right Center Back", "Left Center Back", "Center Back"],
    "FB": ["Left Back", "Right Back", "Left Wing Back", "Right Wing Back"],
    "DM_CM": ["Right Defensive Midfield", "Left Defensive Midfield",
              "Center Defensive Midfield", "Right Center Midfield", "Left Center Midfield"],
    "AM_W": ["Right Wing", "Left Wing", "Center Attacking Midfield",
             "Right Attacking Midfield", "Right Midfield", "Left Midfield"],
    "FW": ["Center Forward", "Right Center Forward", "Left Center Forward"],
}

# FIXED VALUES: class order GK < CB < FB < DM_CM < AM_W < FW.
CLASS_ORDER = ["GK", "CB", "FB", "DM_CM", "AM_W", "FW"]

# The 22 roles in the order above (derived from ROLE_CLASSES).
ROLES = [r for cls in CLASS_ORDER for r in ROLE_CLASSES[cls]]

# FIXED VALUES: per-entity counters of the feature table:
# (name, event type or None, extra condition as SQL or None, summed value as SQL or None).
FOOTBALL_COUNTERS = [
    ("passes", "Pass", None, None),
    ("passes_completed", "Pass", "pass_outcome IS NULL", None),
    ("long_passes", "Pass", "pass_length >= 30", None),
    ("key_passes", None, "pass_shot_assist = true", None),
    ("assists", None, "pass_goal_assist = true", None),
    ("carries", "Carry", None, None),
    ("shots", "Shot", None, None),
    ("goals", None, "shot_outcome = 'Goal'", None),
    ("xg", None, None, "shot_xg"),
    ("dribbles", "Dribble", None, None),
    ("dribbles_completed", "Dribble", "dribble_outcome = 'Complete'", None),
    ("pressures", "Pressure", None, None),
    ("ball_recoveries", "Ball Recovery", None, None),
    ("interceptions", "Interception", None, None),
    ("clearances", "Clearance", None, None),
    ("blocks", "Block", None, None),
    ("duels", "Duel", None, None),
    ("tackles", "Duel", "duel_type = 'Tackle'", None),
    ("fouls", "Foul Committed", None, None),
    ("dispossessed", "Dispossessed", None, None),
    ("miscontrols", "Miscontrol", None, None),
    ("ball_receipts", "Ball Receipt*", None, None),
]

# FIXED VALUES: exposure threshold, per-90 unit, zone bounds, long-pass length.
MIN_EXPOSURE = 450
RATE_UNIT = 90
FINAL_THIRD_X = 80
DEFENSIVE_THIRD_X = 40

# FIXED VALUES: marker event types of the exposure reconstruction.
MATCH_END_MARKER = "Half End"
LINEUP_MARKER = "Starting XI"
SUBSTITUTION_MARKER = "Substitution"

# Features left out of the modelling set (near-duplicates of ratios).
EXCLUDED_FEATURES = ["passes_completed_p90", "dribbles_completed_p90"]
ID_COLUMNS = ["player_id", "pos_purity", "purity6", "minutes"]
