"""Structured Streaming jobs: route, sink, enrich, live state."""
