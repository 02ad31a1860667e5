"""Operators for preparing training data: one module each, bound to tables in queries.py."""
