"""Operators for preparing training data: duplicates, secrets, personal data, toxicity, chat, pieces, shards, packing."""
