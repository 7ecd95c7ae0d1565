"""Readers: report files, nested records, summaries, key-value tables, SQL."""
