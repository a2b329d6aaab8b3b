"""Structured Streaming forms of the topic job and of the topic lookup."""
