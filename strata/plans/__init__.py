"""End-to-end plans: ingestion, health reports, the registered query catalogue."""
