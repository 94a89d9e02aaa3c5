"""DataFrame to DataFrame operators. None of them puts all rows of one key into one task."""
