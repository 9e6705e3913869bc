"""Column functions: text, dates, numbers, JSON and arrays."""
