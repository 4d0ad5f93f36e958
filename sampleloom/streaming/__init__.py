"""Structured Streaming jobs. Every one uses the same column expressions as its batch form."""
