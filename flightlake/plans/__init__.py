"""What to ingest, and the daily run."""
