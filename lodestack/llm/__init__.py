"""Operators for preparing language-model training data, each on Spark DataFrames.

Nothing outside this subpackage imports it.
"""
