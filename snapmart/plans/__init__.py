"""Compositions of operators, checks and table writes."""
