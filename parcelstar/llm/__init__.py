"""Operators for large text corpora: cleaning, matching, tokens, packing and scoring."""
