"""Operators of a training-data pipeline: near-dedup, extraction, classifiers, scans, packing, formatting, media."""
