"""Operators for training-data pipelines on Spark (quality, dedup, PII, mixing, packing, search...)."""
