"""Operators for preparing training data, one module each, and the queries that apply them.

Nothing outside this package imports it.  Shared helpers (staging, scratch paths) come from
``tidemark.session``.
"""
