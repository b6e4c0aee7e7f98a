"""Operators on text corpora: decontamination, mixing, filters, fingerprints and deduplication."""
