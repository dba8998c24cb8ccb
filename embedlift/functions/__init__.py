"""Column builders: metadata rewrites, vector arithmetic, text rules."""
