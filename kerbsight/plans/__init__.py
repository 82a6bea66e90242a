"""End-to-end models built from the operators."""
