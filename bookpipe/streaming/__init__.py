"""Continuous runs over newly landed captures."""
