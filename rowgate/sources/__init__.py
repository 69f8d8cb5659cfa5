"""Readers: delimited text with separator repair, lineage and date ranges."""
