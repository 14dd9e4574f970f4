"""Landing raw data and writing tables."""
