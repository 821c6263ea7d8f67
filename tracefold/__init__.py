"""Captured event streams turned into relational facts, as Spark plans."""
