"""Operators of a training-data pipeline: sharding, token output, near- and
exact-duplicate removal, byte-level BPE, source mixing, quality scoring.

Nothing outside this subpackage imports it, apart from the guarded
registration in ``__spark_entry__`` and ``corpus_pipeline``.
"""
