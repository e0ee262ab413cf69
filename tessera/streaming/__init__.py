"""Reactions to state changes, with Structured Streaming."""
