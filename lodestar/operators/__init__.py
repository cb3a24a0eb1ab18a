"""lodestar.operators."""
