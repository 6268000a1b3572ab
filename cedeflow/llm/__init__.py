"""Operators of a training-data pipeline: cleaning, dedup, mixing, tokens."""
