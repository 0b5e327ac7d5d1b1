"""Incremental table sync on Spark: read, clean, deduplicate, upsert, evolve and audit tables."""
