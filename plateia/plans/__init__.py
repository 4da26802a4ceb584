"""Compositions of operators: the full run and the report pages."""
