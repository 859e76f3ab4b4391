"""Lakehouse analytics operators and marts expressed on Spark DataFrames."""
