"""Spark operators for run-to-failure sensor panels: remaining-life labels, features and models."""

__version__ = "0.1.0"
