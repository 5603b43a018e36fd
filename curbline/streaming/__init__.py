"""Structured Streaming: sources, the enrichment query, dedup, alerts and lag."""
