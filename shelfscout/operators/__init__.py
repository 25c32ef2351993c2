"""Reusable relational steps: top-1 per key, joins on hollow keys, dense rank, checks."""
