"""Operators for preparing training text on Spark: one module per operator, `queries` registers one query for each."""
