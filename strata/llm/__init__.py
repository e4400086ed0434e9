"""Operators for large-scale training-data work; nothing outside this package imports it."""
