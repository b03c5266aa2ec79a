"""Daily quote panel analytics as Spark DataFrame operators.

A panel is a table keyed by (``result_date``, ``cur_unit``) with one ``rate``
per key. Every operator takes DataFrames and plain arguments and returns a
lazy DataFrame.
"""
