"""Tamarack: Spark-first operators for preparing document corpora."""

__version__ = "0.1.0"
