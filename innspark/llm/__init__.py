"""Training-data operators: token stores, mixing, deduplication, language
identification, secret scans, decontamination and page extraction."""
