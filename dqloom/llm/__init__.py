"""Training-data operators: deduplication, decontamination, packing, scoring.

Nothing outside this subpackage imports it. ``dqloom.llm.queries`` holds the
registered queries and their SQL.
"""
