"""Nocturne: a PySpark-native engine for time-domain sky catalogues."""

__version__ = "0.1.0"
