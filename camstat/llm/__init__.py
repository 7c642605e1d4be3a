"""Training-data pipeline operators.

Each module holds one operator with a general interface; ``queries`` applies them to
the given tables as ``opN_<name>``.  Nothing outside this subpackage imports it, except
``__spark_entry__`` (guarded) and ``corpus_pipeline``.
"""
