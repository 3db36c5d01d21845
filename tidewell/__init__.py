"""tidewell: data preparation and table comparison on PySpark DataFrames."""

__version__ = "0.1.0"
