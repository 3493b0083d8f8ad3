"""Training-data operators: sharding, packing, dedup, language, search, toxicity, archives, counts and decontamination."""
