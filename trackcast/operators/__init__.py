"""Relational building blocks (aggregates, joins, top-k, lookups, profiling)."""
