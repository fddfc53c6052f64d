"""Operators that prepare text for training models. Nothing else in the library imports this package."""
