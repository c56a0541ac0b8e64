"""Operators of a training-data pipeline. Nothing outside this subpackage
(and ``corpus_pipeline.py``, which belongs to it) imports it."""
