"""Loomwright: a PySpark-native engine for preparing support knowledge and training text."""

__version__ = "0.1.0"
