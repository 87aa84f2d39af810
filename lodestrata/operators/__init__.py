"""Operators on DataFrames: table, prose and component routes, references, quality, graph."""
