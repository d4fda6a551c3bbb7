"""Tessella: entity-intelligence analytics on Spark DataFrames."""
