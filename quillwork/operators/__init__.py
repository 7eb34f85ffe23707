"""Jobs over DataFrames."""
