"""Operators over DataFrames: verdict, uniqueness, routing, drift, metrics."""
