"""Declarative search, faceting, vector retrieval and search analytics over Spark DataFrames."""
