"""Column functions: built-in expressions except bulk string similarity."""
