"""ledgerspark: a PySpark-native analytics engine for company financials and market series."""

__version__ = "0.1.0"
