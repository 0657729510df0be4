"""Reports built from the operators."""
