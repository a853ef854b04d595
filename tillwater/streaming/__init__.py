"""Structured Streaming: product messages to partitioned Parquet."""
