"""Column functions: text, term expressions, vector arithmetic, list-or-scalar values."""
