"""Relational and sequence operators on DataFrames."""
