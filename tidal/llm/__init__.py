"""Training-data operators: each module is one operator on DataFrames."""
