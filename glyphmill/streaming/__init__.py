"""Checks and counts over growing data sets."""
