"""Writing results: only when changed, data before the pointer to it, archives in tile order."""
