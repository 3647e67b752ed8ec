"""Operators on tables: metadata, adapters for Python objects, slices and masks, package sets."""
