"""Whole data products composed from the operators."""
