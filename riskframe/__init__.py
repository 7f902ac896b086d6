"""riskframe: multi-source risk analytics on entity-keyed Spark DataFrames."""

__version__ = "0.1.0"
