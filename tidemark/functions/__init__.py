"""Column helpers; each returns a built-in Spark expression."""
