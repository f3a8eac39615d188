"""Metric tables, run logs, statuses, tags and catalog tables."""
