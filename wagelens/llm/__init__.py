"""Operators for preparing training data, each under the name of its method."""
