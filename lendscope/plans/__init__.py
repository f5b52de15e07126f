"""Analytical jobs: functions from a ``Star`` to a DataFrame."""
