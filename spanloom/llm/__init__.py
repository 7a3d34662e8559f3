"""Operators for large training-data pipelines.

Each module holds one operator with a general interface; ``queries`` binds
the operators to the driver's tables. Nothing else in the library imports
this subpackage.
"""
