"""Training-data operators: formatting, deduplication, filtering, search, encoding, packing and language."""
