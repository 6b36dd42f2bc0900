"""Whole jobs and the queries over the star-schema tables."""
