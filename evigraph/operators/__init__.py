"""Operators over the logical tables: DataFrame in, DataFrame out."""
