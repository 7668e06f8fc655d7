"""Column functions, Python functions where no built-in serves, and HTML tables."""
