"""isobar.operators."""
