"""Operators for preparing training text: one module per operator, queries on the given tables in ``queries``."""
