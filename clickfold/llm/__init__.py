"""Operators of a training-data pipeline over documents, vectors, pages and
conversations.  Nothing else in the library imports this package."""
