"""Operators for preparing training text: language, quality, duplicates, leaks, personal data, tokens."""
