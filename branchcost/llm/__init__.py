"""Operators for preparing large text corpora, and their registered queries.

Nothing outside this subpackage (and the guarded hook in
``__spark_entry__.py``) imports it.
"""
