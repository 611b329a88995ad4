"""Column expressions: count transforms and vector helpers."""
