"""Operators of a training-data pipeline: text, tokens, near copies, language models.

Nothing outside this folder and ``corpus_pipeline.py`` imports it.
"""
