"""Structured Streaming: record streams in, cleaned tables out."""
