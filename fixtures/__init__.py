"""Bindings of the operators to the test tables, and their DuckDB twins."""
