"""Keyed sales-event processing on Spark DataFrames and Structured Streaming."""
