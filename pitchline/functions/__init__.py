"""Column functions: null-safe arithmetic and the scoring formulas."""
