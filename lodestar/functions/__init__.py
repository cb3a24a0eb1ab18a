"""lodestar.functions."""
