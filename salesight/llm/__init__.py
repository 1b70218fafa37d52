"""Operators that prepare text corpora for training: dedup, filters, mixing, counts."""
