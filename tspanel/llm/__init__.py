"""Operators of a training-data pipeline over tables of documents.

Nothing outside this subpackage imports it; ``catalog`` maps query names to
plans and ``corpus_pipeline.py`` at the repository top chains five of them.
"""
