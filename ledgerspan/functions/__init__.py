"""Column-level functions (text, dates, numbers)."""
