"""Readers and the views that queries share."""
