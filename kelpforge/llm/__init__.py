"""Operators of a training-data pipeline: dedup, scans, scoring, formatting, tokenizing."""
