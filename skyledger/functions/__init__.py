"""Derived values and quality rules as SQL text.

Text keeps a projection of thirty columns one call to Spark. Building the same
from Python column objects takes a call for each operator, and in a
micro-batch that is longer than the batch's own planning. Arguments are
column names or any other SQL expressions.
"""
