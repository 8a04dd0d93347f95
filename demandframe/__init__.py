"""Table operators for demand data on PySpark."""

__version__ = "0.1.0"
