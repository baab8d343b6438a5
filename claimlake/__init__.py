"""PySpark-native analytics for healthcare claims, remittances and payment disputes."""

__version__ = "0.1.0"
