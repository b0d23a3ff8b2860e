"""Landed files, arrival messages and parquet tables."""
