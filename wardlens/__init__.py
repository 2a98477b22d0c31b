"""Clinical risk analytics as Spark DataFrame operators and Spark ML jobs."""

__version__ = "0.1.0"
