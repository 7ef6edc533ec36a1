"""Column expressions: periods, dates and request URLs."""
