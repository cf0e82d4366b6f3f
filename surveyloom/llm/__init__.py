"""Operators of a training-data pipeline; nothing else in the package imports them.

Each module holds one operator. ``queries`` registers one query per operator,
``pipeline`` applies five of them to ``documents``.
"""
