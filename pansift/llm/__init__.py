"""Training-data operators: dedup, tokens, archives, toxicity, mixing, shards, search.

Nothing else in the library imports this subpackage.
"""
