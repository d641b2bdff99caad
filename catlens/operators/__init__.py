"""catlens.operators."""
