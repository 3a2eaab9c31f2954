"""Column functions over one row."""
