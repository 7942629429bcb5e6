"""Document analytics on Spark: lines, units and sidecars as DataFrames."""

__version__ = "0.1.0"
