"""Set-at-a-time operators on DataFrames."""
