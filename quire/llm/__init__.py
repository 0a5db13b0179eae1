"""Operators that prepare corpora for language-model training. Nothing outside this package imports it."""
