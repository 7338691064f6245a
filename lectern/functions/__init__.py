"""Column functions of ids and fields."""
