"""glossa: multilingual corpus building, filtering and measuring on Spark DataFrames."""

__version__ = "0.1.0"
