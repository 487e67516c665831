"""Operators for preparing training text: tokens, duplicates, quality, mixing, search."""
