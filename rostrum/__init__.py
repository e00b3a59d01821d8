"""Speech-corpus preparation and topic initialisation as Spark DataFrame operators."""

__version__ = "0.1.0"
