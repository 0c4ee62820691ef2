"""Operators for preparing training data, apart from the rest of the library."""
