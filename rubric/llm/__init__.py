"""Training-data operators: quality, deduplication, scans, tokens, search, mixing.

Nothing else in the library imports this subpackage.
"""
