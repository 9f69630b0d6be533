"""Keyed event-topic analytics on Spark DataFrames and Structured Streaming."""
