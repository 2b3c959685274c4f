"""Operators for large training-data corpora (WARC bundles, packing, scans, dedup, language models).

Nothing else in the library imports this subpackage.
"""
