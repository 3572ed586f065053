"""Operators of a training-data pipeline (chat formatting to corpus mixing).

Nothing else in the library imports this subpackage.
"""
