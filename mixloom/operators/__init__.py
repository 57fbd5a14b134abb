"""Operators: each call returns a function ``DataFrame -> DataFrame`` for ``DataFrame.transform``."""
