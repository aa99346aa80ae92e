"""Readers: landed JSON feeds, Parquet datasets and tables, envelopes."""
