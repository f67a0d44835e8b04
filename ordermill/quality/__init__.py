"""Data-quality checks as DataFrames; only the final report rows reach the driver."""
