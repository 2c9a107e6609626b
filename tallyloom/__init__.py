"""Cohort-reporting operators for Spark DataFrames."""
