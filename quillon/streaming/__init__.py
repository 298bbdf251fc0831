"""quillon streaming."""
