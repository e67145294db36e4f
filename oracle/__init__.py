"""Comparison SQL: the same results as the Spark plans, in plain SQL over the provided tables."""
