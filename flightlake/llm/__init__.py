"""Operators of a training-data pipeline (text scans, counts, joins, mixing).

Each module holds one operator with its own interface; ``queries`` applies
them to the driver's tables. Nothing outside this subpackage imports it.
"""
