"""Column expressions: text, numbers and identifiers."""
