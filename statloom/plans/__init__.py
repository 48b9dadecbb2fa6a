"""Subject plans built from the operators."""
