"""Operators for building language-model training corpora.

Nothing else in the library imports this subpackage.  ``registry`` holds the
registered queries; every other module is one operator.
"""
