"""Spark-first engine for scientific-literature data and training corpora."""

__version__ = "0.1.0"
