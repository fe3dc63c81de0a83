"""Column expressions: text, arrays, dates, numbers, JSON."""
