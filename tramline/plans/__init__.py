"""Batch pipelines of each layer."""
