"""Lakehouse data work as plain PySpark: every operator maps DataFrames to a DataFrame."""
