"""Column helpers: plain functions that return Column expressions."""
