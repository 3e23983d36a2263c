"""Operators for building training data from a table of documents. Nothing else in the library imports this package."""
