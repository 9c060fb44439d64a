"""Operators over history, distributions and texts.  Nothing outside imports this package."""
