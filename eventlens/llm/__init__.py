"""Operators for preparing text corpora for language-model training.

Each module holds one operator with its own general interface; ``queries`` applies them to
the test tables. Nothing else in the library imports this subpackage.
"""
