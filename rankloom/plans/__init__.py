"""Compositions of operators: search flows and experiments."""
