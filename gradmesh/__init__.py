"""gradmesh: sharded logistic-regression training and its control log, on Spark DataFrames."""

__version__ = "0.1.0"
