"""Operators for training-data pipelines over the ``documents``, ``embeddings``
and ``conversations`` tables. Nothing outside this subpackage imports it."""
