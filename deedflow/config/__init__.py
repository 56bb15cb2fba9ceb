"""Reviewed reference tables."""
