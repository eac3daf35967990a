"""Operators for preparing training data: search, joins, tokens, secrets, quality, languages, repeats and mixing.

Nothing else in the library imports this package. Each operator has a module with its general
interface; ``queries`` holds the registered queries over the given tables.
"""
