"""lodestar.plans."""
