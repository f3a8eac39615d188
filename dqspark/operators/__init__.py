"""DataFrame-to-DataFrame operators: profiles, indicators, sketches, roll-ups, lookups, schemas."""
