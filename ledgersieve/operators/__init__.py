"""Reusable DataFrame operators: skew handling, ranking, rules, checks, profiling."""
