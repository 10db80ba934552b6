"""Column expressions: text, scores, labels, vectors and set similarity."""
