"""Operators for building training corpora: filtering, deduplication, formatting and packing."""
