"""Training-data operators: decontamination, fingerprints, secrets, deduplication, URL filters, mixing, language."""
