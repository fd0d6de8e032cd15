"""Operators for preparing text corpora: identify, deduplicate, filter, mix and tokenize documents."""
