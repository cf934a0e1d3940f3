"""End-to-end runs: landed payloads to gated day tables."""
