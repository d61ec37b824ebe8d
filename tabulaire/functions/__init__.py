"""Column expressions and checks."""
