"""Column-level helpers; everything here maps Columns to Columns."""
