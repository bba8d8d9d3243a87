"""Scalar and aggregate functions, all as built-in column expressions."""
