"""Named analytic jobs for PySpark: every job takes and returns DataFrames."""
