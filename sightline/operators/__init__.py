"""Jobs that take and return DataFrames."""
