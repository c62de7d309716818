"""Column expressions: dates, comment texts, money arithmetic."""
