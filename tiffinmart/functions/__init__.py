"""Column expressions: casts, keys, calendar parts, text cleaning."""
