"""Operators of a training-data pipeline over ``documents``, ``pages`` and ``benchmark`` tables.

Nothing else in the package imports this subpackage.
"""
