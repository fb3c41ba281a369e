"""Operators for building training data from the project's tables."""
