"""sedimart: layered warehouse transformations written as plain Spark DataFrame jobs."""

__version__ = "0.1.0"
