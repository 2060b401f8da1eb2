"""The stateless operators on streaming DataFrames."""
