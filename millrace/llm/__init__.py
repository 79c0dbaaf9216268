"""Operators of a training-data pipeline: near copies, language, quality, mixing,
extraction, tokens, secrets and nearest neighbours.

Nothing else in the library imports this subpackage.
"""
