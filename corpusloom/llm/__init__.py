"""Operators for preparing language-model training corpora.

Every module holds one operator with a general interface; ``queries`` holds the
registered queries derived from them and their SQL oracles.  Nothing outside
this folder and ``corpus_pipeline.py`` imports it.
"""
