"""Operators of a training-data pipeline, one module each, on Spark.

Nothing else in the library imports this subpackage. ``queries`` holds the
registered ``opN_*`` entries; each operator module keeps its own general
interface.
"""
