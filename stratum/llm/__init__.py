"""Operators of a training-data pipeline over whole text tables; nothing outside this package imports it."""
