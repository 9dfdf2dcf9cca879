"""Scalar Column expressions: dates, labels, predicates."""
