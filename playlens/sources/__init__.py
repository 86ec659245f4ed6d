"""Readers and writers: text at the edges, typed parquet inside."""
