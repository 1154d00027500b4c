"""Column expressions and SQL-registered functions."""
