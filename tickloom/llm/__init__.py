"""Operators for training-data pipelines over text and vectors, and their registered queries.

Nothing else in the library imports this subpackage. ``queries`` holds the registered
queries, ``checks`` their SQL; every other module is one operator or a helper.
"""
