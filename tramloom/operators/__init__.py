"""Transit operators over DataFrames."""
