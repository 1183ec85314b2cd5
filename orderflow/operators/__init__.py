"""Relational operators of the pipeline built from DataFrame primitives."""
