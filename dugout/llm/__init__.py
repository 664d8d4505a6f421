"""Operators for preparing training data: each module is one operator, ``queries`` registers them.

Nothing else in the library imports this package.
"""
