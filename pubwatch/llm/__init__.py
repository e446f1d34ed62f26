"""Training-data operators: tokens, search, archives, duplicates, mixing, extraction, toxicity."""
