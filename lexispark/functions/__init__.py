"""Column expression builders (Catalyst only, no Python in the hot path)."""
