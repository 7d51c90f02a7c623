"""lexispark: a Spark-first engine for lexicographic and document data."""

__version__ = "0.1.0"
