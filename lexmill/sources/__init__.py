"""Readers: the source catalogue, fetched pages, markup, documents, JSON files and seed tables."""
