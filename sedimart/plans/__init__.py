"""The warehouse's tables, each a composition of operators over its input tables."""
