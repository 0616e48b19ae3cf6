"""Batch sources. The format is a parameter wherever a connector may be missing."""
