"""quillon sources."""
