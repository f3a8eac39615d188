"""Physical-plan helpers: size checks before broadcasts, interval joins, lineage cuts."""
