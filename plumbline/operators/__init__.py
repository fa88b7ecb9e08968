"""Operators: cleaning, transforms, profiling, splits, models, selection."""
