"""catlens.plans."""
