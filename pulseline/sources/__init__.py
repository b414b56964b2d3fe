"""Sources of raw lines."""
