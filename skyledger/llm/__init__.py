"""Operators of a training-data pipeline: mixing, extraction, fingerprints, search,
near-duplicate joins, packing and the classifiers and filters around them."""
