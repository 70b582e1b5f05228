"""Structured Streaming jobs: watermarked daily volume and file-stream ingestion."""
