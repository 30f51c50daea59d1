"""Operators of a training-data pipeline: filtering, deduplication, mixing, tokenising and
search over document, page, conversation and embedding tables. Nothing else in the library
imports this subpackage."""
