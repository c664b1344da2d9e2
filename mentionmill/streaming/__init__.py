"""Streams: batches that arrive as files, each key handled once."""
