"""quillon engine."""
