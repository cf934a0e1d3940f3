"""Flight positions, airport weather and world geography as plain Spark DataFrame work."""

__version__ = "0.1.0"
