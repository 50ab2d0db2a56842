"""tspanel — PySpark operators for panels of time series (unique_id, ds, y)."""

__version__ = "0.1.0"
