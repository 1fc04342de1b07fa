"""Operators for training data: deduplication, packing, tokens, archives, quality. Nothing else here imports them."""
