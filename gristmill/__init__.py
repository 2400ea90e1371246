"""Relational, data-quality, ingest and export operators as functions over Spark DataFrames."""
