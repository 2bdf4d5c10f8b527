"""Operators of a training-data pipeline, each a Spark job of its own.

Nothing else in the library imports this subpackage.  ``registry`` lists the
``opN_`` queries; every operator module documents its edge cases.
"""
