"""Structured Streaming jobs. Every writer returns its StreamingQuery; the caller awaits it."""
