"""Scalar functions on text, references, JSON and identifiers."""
