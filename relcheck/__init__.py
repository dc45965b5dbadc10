"""relcheck: release checks for tables and event streams on Spark."""

__version__ = "0.1.0"
