"""Tabular profiling, preparation, training and scoring on Spark DataFrames."""
