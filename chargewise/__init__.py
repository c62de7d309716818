"""Weekly vendor-compliance chargeback jobs on Spark DataFrames."""

__version__ = "0.1.0"
