"""Operators for training-data pipelines: tokens, quality, personal data, duplicates, languages, search and packing."""
