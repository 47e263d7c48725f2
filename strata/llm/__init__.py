"""Operators for training-data pipelines: format, deduplicate, classify, mix, tokenise, pack."""
