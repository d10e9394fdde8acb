"""Training-data operators: quality, secrets, tokens, search, dedup, packing, scoring, archives.

Nothing outside this package imports it. ``catalog`` lists its queries.
"""
