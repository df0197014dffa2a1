"""Training-data operators: mixing, near duplicates, scoring, filtering, sharding.

Each module is one operator with its own interface; ``queries`` registers the
thin ``opN_*`` digests over the given tables. Nothing outside this package
imports it.
"""
