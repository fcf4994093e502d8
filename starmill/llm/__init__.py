"""Operators for large text corpora: search, cleaning, extraction, packing."""
