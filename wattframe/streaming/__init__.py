"""Continuous arrival of page files."""
