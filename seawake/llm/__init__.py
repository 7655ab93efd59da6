"""Operators of a large-scale training-data pipeline, one module per operator.

Nothing else in the library imports this package; the entry module adds its queries only
when it can be imported.
"""
