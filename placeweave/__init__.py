"""Conforming, keying and cross-walking place-keyed tables on Spark DataFrames."""
