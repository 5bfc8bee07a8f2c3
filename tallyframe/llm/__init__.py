"""Operators of a training-data pipeline: formatting, tokens, scans, dedup, mixing, models, WARC.

Each operator lives in one module and takes and returns DataFrames; ``queries`` registers one
query per operator.  Nothing outside this package imports it except ``__spark_entry__``.
"""
