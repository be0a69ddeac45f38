"""Spark-native analytics for keyed availability time series (dock-station status feeds)."""

__version__ = "0.1.0"
