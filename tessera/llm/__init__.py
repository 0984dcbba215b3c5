"""Operators of a training-data pipeline: filters, scans, classifiers,
tokenisation, extraction, de-duplication and mixing, each over Spark tables.

Every operator takes DataFrames and returns DataFrames; nothing else in the
library imports this subpackage.  ``llm.queries`` registers one query per
operator, ``corpus_pipeline`` chains five of them.
"""
