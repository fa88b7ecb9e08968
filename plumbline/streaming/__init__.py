"""Fitted transforms on streaming frames."""
