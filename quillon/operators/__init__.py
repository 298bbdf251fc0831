"""quillon operators."""
