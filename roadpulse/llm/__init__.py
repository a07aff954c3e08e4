"""Operators for large text corpora, their registered queries and the corpus pipeline's parts."""
