"""Operators for text corpora: near-duplicates, leakage, mixing, spam. Nothing outside this package imports it."""
