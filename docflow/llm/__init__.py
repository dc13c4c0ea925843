"""Operators for training-data pipelines: scoring, tokens, decontamination, extraction, filters, near-duplicates."""
