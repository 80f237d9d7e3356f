"""Tidemark: lakehouse-style data operators built on Spark DataFrames."""

__version__ = "0.1.0"
