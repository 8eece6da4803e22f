"""Readers, writers and ingestion metadata."""
