"""Batch and stream transformations, grouped by layer."""
