"""Stateless contract checks on streaming DataFrames."""
