"""Column expressions, fixed business values and skew-safe building blocks."""
