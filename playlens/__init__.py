"""Play-event analytics, advertising and recommendations on Spark DataFrames."""

__version__ = "0.1.0"
