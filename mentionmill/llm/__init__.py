"""Operators for large training-text corpora.

Nothing else in the package imports this subpackage; its queries join the
registry of ``__spark_entry__.py`` when it can be imported.
"""
