"""Jobs over DataFrames, one module per subject."""
