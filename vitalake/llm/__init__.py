"""Operators of a training-data pipeline: language ID, deduplication,
decontamination, scoring, classification, PII and packing.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
