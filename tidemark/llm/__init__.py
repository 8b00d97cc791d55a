"""Operators for training data: each module is one operator by one method."""
