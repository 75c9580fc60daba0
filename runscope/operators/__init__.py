"""Report operators: DataFrame to DataFrame."""
