"""Keeps the history of tables whose source forgets: incremental ingest, dedup, verification and freshness on plain Spark."""
