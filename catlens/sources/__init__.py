"""catlens.sources."""
