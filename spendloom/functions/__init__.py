"""Column expressions: dates, text, numbers, lookups, nested values."""
