"""Column expressions: rounding, grid cells, scoring, text and time."""
