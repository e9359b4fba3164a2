"""Column functions: rounding, projection, colours, numerals."""
