"""Training-data operators: language id, token counts, license scans, BPE, decontamination, near-duplicates, line
dedup, quality scores, fingerprints and pseudonyms. Nothing else in the library imports this package."""
