"""Incremental variants: append-only ingestion and keyed upsert."""
