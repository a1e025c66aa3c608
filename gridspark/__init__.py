"""Spark jobs and queries for electricity open data.

Every public function takes and returns DataFrames (or Columns) and stays lazy
unless its docstring says otherwise.
"""

__version__ = "0.1.0"
