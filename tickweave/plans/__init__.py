"""Whole queries over the stored tables."""
