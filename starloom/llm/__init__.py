"""Operators of a training-data pipeline: extraction, quality, filters, mixing, personal data, duplicates, tokens."""
