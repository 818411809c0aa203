"""Operators of a language-model training-data pipeline, each on Spark DataFrames."""
