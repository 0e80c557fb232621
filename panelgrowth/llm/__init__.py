"""Training-data operators: mixing, dedup, quality, token files, packing, archives.

Nothing else in the library imports this package.
"""
