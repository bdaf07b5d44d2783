"""Compositions of operators, end to end."""
