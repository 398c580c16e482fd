"""Operators for training corpora; the queries over the given tables are in ``queries``."""
