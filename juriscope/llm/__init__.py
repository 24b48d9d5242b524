"""Operators for preparing training data at scale.

Each module holds one operator: a general function over DataFrames and the
thin query that applies it to a whole table.  Nothing outside this subpackage
imports it.
"""
