"""Operators for text corpora: search, filters, duplicates, extraction, tokens, archives.

Nothing outside this package imports it; ``queries`` registers its queries.
"""
