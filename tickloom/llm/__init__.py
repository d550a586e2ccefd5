"""Operators for text corpora: formatting, tokens, quality, duplicates, search, leaks, packing and url rules."""
