"""Reading and writing: API pages, extracts, landing tables, seeds, marts."""
