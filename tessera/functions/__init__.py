"""Column functions: text, arrays, string similarity."""
