"""Operators for preparing texts and labels as training data.  Nothing else in the library imports this package."""
