"""Operators for large training corpora; nothing outside this package uses them."""
