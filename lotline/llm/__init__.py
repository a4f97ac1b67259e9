"""Training-data operators: dedup, search, fingerprints, classifiers, WARC, tokens, packing."""
