"""Regulatory and accounting text to clean, validated, training-ready tables, on Spark DataFrames."""
