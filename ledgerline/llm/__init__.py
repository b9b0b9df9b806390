"""Operators for training data: text, tokens, near copies, filters, search."""
