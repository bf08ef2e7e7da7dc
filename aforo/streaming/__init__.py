"""Gate events as they arrive."""
