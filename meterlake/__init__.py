"""A monthly trip-record lakehouse written as Spark DataFrame code.

Raw files land in ``bronze``, are normalized, deduplicated, flagged and merged
into ``silver``, and feed the dimensions, fact, marts and monitoring in ``gold``.
"""
