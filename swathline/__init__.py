"""Radar scene analytics on Spark DataFrames."""
