"""Relational operators: deduplication, control, integrity, mutation, history, ranking and quality."""
