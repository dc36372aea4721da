"""Nested exports built from the driver's tables, and the queries checked on them."""
