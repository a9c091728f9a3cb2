"""Training-data operators: scoring, dedup, mixing, packing, search, archives."""
