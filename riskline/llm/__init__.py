"""Operators and queries of a training-data pipeline (texts, pages, chats).

One module per operator; ``queries`` registers the thin ``opN_<name>`` queries.
Nothing else in the library imports this package.
"""
