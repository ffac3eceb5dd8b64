"""Reading raw tables."""
