"""Operators that prepare text for language-model training.

Nothing outside this package imports it. Every operator takes and returns
DataFrames; :mod:`quillmark.llm.registry` holds the registered queries.
"""
