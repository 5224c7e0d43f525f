"""Column expressions: calendar, arithmetic, names."""
