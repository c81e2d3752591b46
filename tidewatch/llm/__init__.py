"""Operators of a training-data pipeline (formatting, dedup, archives, packing,
scans, classifiers, sharding).  Nothing else in the library imports this package."""
