"""Operators of a training-data pipeline: tokens, fingerprints, scans, near duplicates, packing, toxicity."""
