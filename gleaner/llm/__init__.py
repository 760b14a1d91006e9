"""Operators that prepare text and records for language models. Nothing else in the library imports this package."""
