"""Importing this package registers every query."""

from tidemark.plans.queries import aggregates, columns, dimensions, joins, quality, search, storage  # noqa: F401
