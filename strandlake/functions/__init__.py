"""Column functions over sequences and headers."""
