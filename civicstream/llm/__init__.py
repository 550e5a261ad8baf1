"""Operators for preparing training text: tokenization, filtering, deduplication, scoring.

Nothing else in the package imports this subpackage.
"""
