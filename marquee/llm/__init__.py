"""Training-data operators: filters, near-duplicates, packing, scoring."""
