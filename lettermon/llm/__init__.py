"""Operators of a training-data pipeline, one module each.

Nothing outside this folder imports it.  Every operator takes and returns
DataFrames and names the columns it needs; columns it does not know are
left alone.
"""
