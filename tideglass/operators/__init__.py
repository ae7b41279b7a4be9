"""DataFrame-in, DataFrame-out operators, with column names as parameters."""
