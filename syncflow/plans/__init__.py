"""Flow descriptions and the queries built from the operators."""
