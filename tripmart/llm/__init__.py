"""Operators of a training-data pipeline over documents, labels and embeddings.

Nothing else in the library imports this package. Every operator picks the
columns it needs, so other columns of its input, whatever their names, pass by
unseen.
"""
