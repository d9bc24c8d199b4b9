"""millrace: build and analyse code/prose example sets with Spark DataFrames."""

__version__ = "0.1.0"
