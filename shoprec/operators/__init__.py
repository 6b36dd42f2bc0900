"""Relational and learning operators, each a function of DataFrames."""
