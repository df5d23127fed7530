"""Column functions: dates, values and vectors."""
