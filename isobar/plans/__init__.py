"""isobar.plans."""
