"""PySpark-native analytics over network-sighting tables."""

__version__ = "0.1.0"
