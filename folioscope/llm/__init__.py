"""Operators that prepare text corpora for language models."""
