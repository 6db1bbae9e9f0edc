"""Column functions: text, keys, dates, names and similarity."""
