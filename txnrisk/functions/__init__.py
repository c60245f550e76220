"""Column expressions. All are built-in Spark functions: no Python runs per row."""
