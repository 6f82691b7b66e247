"""Retail analytics as ordinary Spark plans: clean, unify, net off returns, answer, keep history, check."""
