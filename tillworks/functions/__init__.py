"""Column functions and skew-safe grouping helpers."""
