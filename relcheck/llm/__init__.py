"""Operators for preparing training text: one module an operator, each
DataFrame in and DataFrame out; ``queries.py`` registers one query each."""
