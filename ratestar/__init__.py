"""Rate-based quality-measure analytics on PySpark DataFrames."""
