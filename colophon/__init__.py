"""Bibliographic analytics on Spark: ingest, checks, author queries and co-author graphs."""

__version__ = "0.1.0"
