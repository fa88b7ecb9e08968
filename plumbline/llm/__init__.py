"""Operators for text training data; nothing outside this folder imports it."""
