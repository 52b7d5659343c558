"""Domain operators: pure functions from DataFrame to DataFrame."""
