"""Training-data operators: quality, near-dedup, packing, scans and archives."""
