"""Hourly electricity-grid analytics as composable PySpark DataFrame transformations."""
