"""Reliability reports over daily drive telemetry, built on Spark DataFrames."""
