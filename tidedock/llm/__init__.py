"""Operators for training-data pipelines over ``documents``, ``labels`` and ``pages``.

Nothing else in the library imports this package.
"""
