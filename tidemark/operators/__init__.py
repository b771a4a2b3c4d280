"""Relational operators: joins, aggregates, windows, dimensions, checks, search."""
