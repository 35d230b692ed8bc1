"""Operators of a training-data pipeline.

One module per operator.  Nothing else in the library imports this package;
``llm.queries`` holds the registered queries and their SQL.
"""
