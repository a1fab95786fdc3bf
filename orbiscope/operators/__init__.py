"""Operators: DataFrame in, DataFrame out, no side effects."""
