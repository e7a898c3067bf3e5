"""Structured Streaming over logs: file-source streams, cursor commits, the commit rule, log sink."""
