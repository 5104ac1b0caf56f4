"""Operators for training-data pipelines: language, duplicates, contamination, tokens, quality, secrets, privacy, chat."""
