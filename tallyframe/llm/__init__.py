"""Operators for preparing text corpora for model training.

Each module holds one operator with a general DataFrame interface;
``queries`` holds the thin registered queries over the test tables.
Nothing else in the library imports this subpackage.
"""
