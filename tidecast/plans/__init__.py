"""Compositions of operators into the runs a user starts."""
