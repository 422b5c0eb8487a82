"""Training-data operators: search, filtering, packing, deduplication, archives, mixing and redaction."""
