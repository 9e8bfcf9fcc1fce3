"""Operators for training-data pipelines: quality, duplicates, languages, tokens, packing and mixing.

Nothing else in the package imports this one.
"""
