"""Readers of captured pages and of saved state."""
