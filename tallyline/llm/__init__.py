"""Operators for large text corpora: duplicates, leaks, languages, packing, scoring.

Nothing outside this subpackage imports it.
"""
