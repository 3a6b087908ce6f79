"""Operators for preparing training text: each one a Spark job over a table of documents."""
