"""Incremental jobs: Structured Streaming over the landing folder."""
