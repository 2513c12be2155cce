"""Scalar functions on columns. All are native expressions unless they say otherwise."""
