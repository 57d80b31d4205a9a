"""Column expressions: vectors, JSON, text."""
