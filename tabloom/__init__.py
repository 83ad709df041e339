"""Relational analytics operators on PySpark DataFrames."""
