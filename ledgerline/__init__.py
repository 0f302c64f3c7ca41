"""A PySpark-native analytics library for filings data."""
