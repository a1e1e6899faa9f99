"""Where data comes from and goes to: streams, lake tables, and inputs derived from given tables."""
