"""Operators for preparing training data: text, vectors and pages at corpus scale.

Nothing else in the library imports this subpackage.
"""
