"""Operators of a training-data pipeline: extraction, search, near-duplicates, rules, packing, tokens, quality.

Nothing outside this folder imports it.  ``queries`` has one query per operator,
``oracle`` the expected results that SQL can express.
"""
