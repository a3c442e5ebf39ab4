"""Column expressions and row-wise DataFrame functions."""
