"""Training-data operators: language ID, packing, deduplication, formatting, search, sharding and tokenisation.

Nothing outside this subpackage imports it. ``oreline.llm.queries`` registers one query an operator.
"""
