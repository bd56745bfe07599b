"""Reusable relational steps.  Each takes and returns DataFrames; none collects rows."""
