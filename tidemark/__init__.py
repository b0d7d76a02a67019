"""tidemark: keyed daily-series analytics written as lazy Spark DataFrame operators."""

__version__ = "0.1.0"
