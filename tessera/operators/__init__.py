"""Relational operators: each takes and gives DataFrames."""
