"""Relational operators: scoring, ranking, selection, joins, splits, shredding."""
