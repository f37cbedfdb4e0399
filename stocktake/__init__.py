"""Retail and event analytics on Spark DataFrames."""
