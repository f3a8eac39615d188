"""Column expressions: projections, labels, fingerprints, time handling, geometry headers."""
