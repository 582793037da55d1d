"""isobar.sources."""
