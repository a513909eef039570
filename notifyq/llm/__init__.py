"""Operators for preparing training text at scale.

Nothing else in the library imports this package. Each module holds one operator with a
general interface; ``notifyq.llm.queries`` holds the thin registered queries and their SQL.
"""
