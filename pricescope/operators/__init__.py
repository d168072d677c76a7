"""Analytic operators.  Every function maps DataFrames (+ parameters) to a
lazy DataFrame; nothing here collects rows to the driver."""
