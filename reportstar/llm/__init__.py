"""Operators that prepare training text, each a job on DataFrames of documents.

Nothing outside this package imports it. Every operator takes columns by name, so that extra columns of
the input, whatever they are called, never collide with its own.
"""
