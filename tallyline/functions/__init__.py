"""Column helpers built from native expressions."""
