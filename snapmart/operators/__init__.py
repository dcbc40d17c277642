"""Pure operators: DataFrames in, DataFrames out, no writes."""
