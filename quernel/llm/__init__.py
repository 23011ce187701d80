"""Operators for text corpora and entity fusion. Nothing else in the library imports this package."""
