"""End-to-end chains and the queries built from the given tables."""
