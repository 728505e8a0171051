"""Registering sources: listings, recipes, file rows, and readers of their text formats."""
