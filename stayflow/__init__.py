"""Spark operators that turn movement histories into one row per stay."""
