"""Table operators, each DataFrame -> DataFrame with column names as arguments."""
