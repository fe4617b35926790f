"""Operators that prepare training text: language, quality, near and exact duplicates, tokens, archives."""
