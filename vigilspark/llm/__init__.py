"""Operators that prepare training text: extraction, filtering, near-duplicate removal, tokenising."""
