"""Operators for preparing language-model training data, and their queries.

Nothing outside this subpackage imports it except the guarded lookup in
``__spark_entry__.py``.
"""
