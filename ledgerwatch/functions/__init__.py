"""Column expressions: privacy, time, geography."""
