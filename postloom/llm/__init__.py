"""Training-data operators: tokenising, deduplication, search, packing, quality and web pages."""
