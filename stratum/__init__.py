"""Medallion-lakehouse operators written as plain ``DataFrame -> DataFrame`` functions."""
