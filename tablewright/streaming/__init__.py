"""Typed tables as streams."""
