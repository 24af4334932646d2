"""Operators for preparing training data at corpus scale.

Nothing else in the library imports this subpackage. Each module holds one
operator with its own general interface; ``queries`` registers one thin query
per operator over the supplied tables.
"""
