"""Column functions and patterns."""
