"""Training-data operators: dedup, filters, archives, mixing, language ID, token output."""
