"""Table layouts and the dataset registry."""
