"""Warehouse loading and reconciliation as Spark DataFrame operators.

Every operator takes DataFrames and explicit dates and returns DataFrames. Nothing here
reads the wall clock, so a run can be repeated and checked.
"""

__version__ = "0.1.0"
