"""lodestar.sources."""
