"""Loamgrid: analytics over versioned, multi-source knowledge data, on DataFrames."""
