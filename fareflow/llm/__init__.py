"""Operators for training data: text, near copies, mixtures, vectors and archives.

Nothing else in the package imports this part.
"""
