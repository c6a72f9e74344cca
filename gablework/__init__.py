"""Tabular preparation, regression and explanation on Spark DataFrames."""

__version__ = "0.1.0"
