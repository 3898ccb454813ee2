"""Training-data operators: quality, dedup, PII, mixing, packing, formatting."""
