"""Relational building blocks shared by the rules: predicates, joins, top-k with ties,
aligned union, duplicate-id suffixing."""
