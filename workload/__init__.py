"""Queries over data derived from the test tables, with their DuckDB counterparts."""
