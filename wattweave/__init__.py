"""wattweave: Spark-native feature tables for energy time series."""

__version__ = "0.1.0"
