"""Readers and writers: match-log JSONL, driver parquet tables, CSV, models, runs."""
