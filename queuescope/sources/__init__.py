"""Readers, writers and state tables."""
