"""Table operators."""
