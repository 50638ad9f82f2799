"""Relational, statistical and modelling operators; each takes and returns DataFrames."""
