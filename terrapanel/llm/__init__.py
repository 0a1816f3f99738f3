"""Training-data operators: thirteen operators on Spark DataFrames.

Nothing outside this subpackage imports it.  Every operator takes and returns
DataFrames; ``queries.py`` holds the thin registered queries and ``oracle.py``
their SQL where SQL can express the result.
"""
