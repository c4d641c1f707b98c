"""Operators of a training-data pipeline, each by a method of its own.

Every module holds one operator with its own interface and a thin query over the
``documents`` table. Nothing outside this package imports it.
"""
