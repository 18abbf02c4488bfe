"""Whole procedures: transforms, load, pipeline, analytics."""
