"""Operators of a training-data pipeline over whole corpora of documents."""
