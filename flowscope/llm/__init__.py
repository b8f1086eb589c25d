"""Operators for large training corpora.

Each operator lives in its own module, takes and returns DataFrames, and is
registered as one query ``opN_<name>`` in ``queries.py`` (SQL twins, where SQL
can express the result, in ``oracle.py``). Nothing outside this subpackage
imports it.
"""
