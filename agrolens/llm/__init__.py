"""Operators of a training-data pipeline over documents, pages and conversations.

Nothing else in the library imports this package. ``catalog`` registers one query per
operator; ``corpus_pipeline.py`` at the repository top chains five of them.
"""
