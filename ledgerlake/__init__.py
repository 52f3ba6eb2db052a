"""Banking analytics on Spark DataFrames: cleaning, audit, star schema, marts and series."""

__version__ = "0.1.0"
