"""Experiment operators: each takes and returns DataFrames."""
