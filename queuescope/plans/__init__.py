"""Queries: whole plans over a directory of tables."""
