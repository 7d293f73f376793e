"""Bounded record pipelines on Spark: generate, ingest, sort by every key, verify."""
