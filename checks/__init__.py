"""Registered queries over the test tables, each beside its DuckDB twin."""
