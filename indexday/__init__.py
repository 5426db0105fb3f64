"""Cohort and outcome analytics over longitudinal event tables, on Spark DataFrames."""

__version__ = "0.1.0"
