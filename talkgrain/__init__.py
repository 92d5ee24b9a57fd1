"""Contact-centre conversation analytics as composable Spark transforms."""

__version__ = "0.1.0"
