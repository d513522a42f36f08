"""Column expressions: timestamps, JSON text, HTML text, names."""
