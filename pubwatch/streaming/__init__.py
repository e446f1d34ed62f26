"""Structured Streaming jobs: ingest, deduplication, volumes, enrichment and upsert."""
