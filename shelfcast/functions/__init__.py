"""Column expressions, and the curve fit that runs inside tasks."""
