"""Posting enrichment on Spark: clean, deduplicate, enrich and account for
large tables of titled documents with DataFrame operators."""

__version__ = "0.1.0"
