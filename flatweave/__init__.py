"""Flatten nested analytics exports into relational tables with Spark."""
