"""Operators over whole tables: change capture, splits, joins, profiles, checks and rules."""
