"""Operators for preparing training data: filtering, deduplication, search and tokenization of text at scale."""
