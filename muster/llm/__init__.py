"""Operators of a training-data pipeline: sharding, near-duplicates, tokens, secrets, language models, filters.

Nothing outside this subpackage imports it.
"""
