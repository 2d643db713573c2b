"""Operators of a training-data pipeline.

Each module holds one operator with a general interface (DataFrames in and
out); ``queries.py`` registers one thin query per operator.  Nothing outside
this folder and ``corpus_pipeline.py`` imports it.
"""
