"""Whole jobs, put together from the operators."""
