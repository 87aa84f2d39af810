"""Column functions: text, numbers, citations, units, names and keys."""
