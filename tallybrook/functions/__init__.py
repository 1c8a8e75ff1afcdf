"""Column expressions. All are built-in Spark functions; none calls Python per row."""
