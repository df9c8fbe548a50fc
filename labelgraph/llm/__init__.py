"""Training-data operators: dedup, decontamination, formatting, sharding, archives, filters, mixing.

Nothing outside this subpackage imports it; ``queries`` holds the registered queries and their SQL.
"""
