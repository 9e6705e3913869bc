"""Relational building blocks: merges, increments, keyed picks, joins, aggregates."""
