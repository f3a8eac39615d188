"""Datasets, object notifications, path fields and record merging."""
