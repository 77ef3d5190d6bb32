"""Stores: saved state in, new rows out."""
