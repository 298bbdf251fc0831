"""quillon functions."""
