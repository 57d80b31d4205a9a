"""Operators for training data: sampling, splits, text defects, tokens, leaks, pieces."""
