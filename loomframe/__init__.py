"""User-level analytics operators and pipelines on Spark DataFrames.

Every function takes and returns lazy DataFrames built from Spark's own column
expressions; outside of the operators for training corpora, which nothing else
uses, nothing collects rows or runs Python on the executors.
"""
