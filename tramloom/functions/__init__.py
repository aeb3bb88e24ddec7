"""Column expressions and the as-of lookup."""
