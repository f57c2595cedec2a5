"""Operators: ``DataFrame -> DataFrame`` functions that chain with ``df.transform``."""
