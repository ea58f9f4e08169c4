"""Strandlake: episodes of multi-rate sensor streams on Spark DataFrames."""
