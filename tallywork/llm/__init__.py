"""Operators and queries for preparing large training corpora."""
