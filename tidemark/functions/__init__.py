"""Column expressions: dates and paths, typed casts, JSON text."""
