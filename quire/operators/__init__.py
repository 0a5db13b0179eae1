"""Operators over documents, pages, words and results."""
