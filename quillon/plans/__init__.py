"""quillon plans."""
