"""Column expressions: time, ids, text and the mapping language."""
