"""Training-data operators: scans, deduplication, packing, filtering, mixing and web archives.

Nothing else in the library imports this subpackage.
"""
