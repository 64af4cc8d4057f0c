"""Column expressions: text, paths, JSON and record rules."""
