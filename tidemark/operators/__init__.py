"""Operators on article, event and review tables."""
