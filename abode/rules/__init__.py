"""Ordered category rule tables, as data."""
