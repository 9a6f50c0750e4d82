"""Column expressions: text, numbers, geometry."""
