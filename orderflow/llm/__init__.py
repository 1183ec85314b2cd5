"""Operators for large training-corpus pipelines, one module each.

Nothing else in the package imports this subpackage.
"""
