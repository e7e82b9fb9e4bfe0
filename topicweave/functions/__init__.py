"""Column expressions (text, arrays, distributions) and fixed values."""
