"""Column functions: keys, calendar arithmetic and metric formulas."""
