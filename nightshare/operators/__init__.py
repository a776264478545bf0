"""Reusable relational operators: joins, picks, quantiles, sets, checks."""
