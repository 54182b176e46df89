"""Operators for building training corpora: quality, tokens, duplicates, toxicity, mixing, shards, models."""
