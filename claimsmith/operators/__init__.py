"""operators."""
