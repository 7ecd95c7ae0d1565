"""Column-in, column-out functions (text, dates, numbers, HTML)."""
