"""Training-data operators: deduplication, scoring, search, mixing and packing.

Nothing outside this subpackage imports it; removing the folder leaves the rest working.
"""
