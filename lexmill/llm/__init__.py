"""Operators for building training corpora: chat rendering, mixing, deduplication,
decontamination, URL and quality filters, vector search, secret scans, HTML extraction.

Nothing outside this subpackage imports it; it can be removed as a whole.
"""
