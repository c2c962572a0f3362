"""Reading source tables."""
