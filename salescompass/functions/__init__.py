"""Column expressions: dates, money, scores and text."""
