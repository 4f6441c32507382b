"""Incremental ELT and star-schema revenue analytics as PySpark DataFrame operators."""

__version__ = "0.1.0"
