"""Training-data operators: tokenising, formatting, cleaning, dedup, sharding, scoring and archives.

Nothing else in the library imports this subpackage.
"""
