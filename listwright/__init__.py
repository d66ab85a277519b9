"""Listing intelligence on Spark: ingest, filter, deduplicate, track changes, report."""
