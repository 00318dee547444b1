"""Structured Streaming: change capture as contents arrive, and windows over events."""
