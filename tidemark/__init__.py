"""Tidemark: an analytics engine for decoded ledger events, built on PySpark."""
