"""Batch and streaming table operations written as plain PySpark."""
