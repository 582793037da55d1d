"""isobar.functions."""
