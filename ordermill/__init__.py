"""Retail order analytics on Spark: ingest, clean, enrich, aggregate, load and check."""
