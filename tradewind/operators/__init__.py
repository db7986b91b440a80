"""The analytics operators. Each takes and returns DataFrames."""
