"""The engine has no streaming operators: what it computes, it computes over whole tables.

Late decision rows are settled in batch by ``weft.operators.relational.latest``.
"""
