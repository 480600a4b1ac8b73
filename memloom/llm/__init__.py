"""Training-data operators: filtering, deduplication, search, tokenization and scans.

Every module holds one operator with a general interface; ``queries`` binds
the operators to the tables.  Nothing outside this subpackage imports it.
"""
