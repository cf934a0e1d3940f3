"""Continuous ingestion of landed snapshots."""
