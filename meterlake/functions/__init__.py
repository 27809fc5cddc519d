"""Column expressions: keys, casts, quality flags and calendar helpers."""
