"""Structured Streaming forms of the hashtag jobs."""
