"""tabready: model-readiness and model-comparison operators on Spark DataFrames."""

__version__ = "0.1.0"
