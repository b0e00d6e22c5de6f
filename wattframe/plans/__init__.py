"""Whole builds composed from sources and operators."""
