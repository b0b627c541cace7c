"""Operators for building training data: extraction, sharding, formatting, scoring, dedup, tokens.

Nothing else in the package imports this subpackage; ``queries.py`` registers its queries.
"""
