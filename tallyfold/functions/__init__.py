"""Column expressions; all built-in functions, no UDF."""
