"""Training-data operators: quality, decontamination, sharding, language,
search, personal data, archives, near duplicates and packing."""
