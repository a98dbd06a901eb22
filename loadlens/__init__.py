"""Load, data-quality and table-audit operators for period-stamped data on Spark."""

__version__ = "0.1.0"
