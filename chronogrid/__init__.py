"""Time-series label engine on PySpark DataFrames."""
